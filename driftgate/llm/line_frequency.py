"""Quality rules: cross-document line frequency.

Every line is normalised (A-Z lower-cased, digits taken as 0, runs of white
space as one, ends trimmed) and hashed.  Per host the number of distinct
documents that hold a line is counted; exact copies of one text count as one
document: counted one by one, a page dealt ``min_docs`` times would lose all
its lines in all its copies, so that no copy of its prose would stay.  A line
is boilerplate and goes if it is in ``min_docs`` texts of its host, however
many the host has; or in ``some_docs`` that are ``min_share`` of the host's; or,
on a small host, in ``least_docs`` that are ``small_share`` of them.  Fewer than
``least_docs`` texts do not tell a habit of the host from a quotation.
A document is kept if at least ``keep_share`` of its
words and ``keep_words`` words stay.

The texts are given back without their boilerplate lines, byte for byte as they
were otherwise; a text and its host are known by a 64-bit hash.  Exact
copies are judged once, and the verdict is joined back to each copy's text.

Defined cases: null text has no words, counts as the empty text and stays null; a null host is a host
of its own; rows that repeat a document id are judged row by row (all copies of
a row get the verdict of their text); an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftgate.llm.store import checkpointed, ship
from driftgate.llm.words import Texts, covered, mix, prefix_sum, slices, spans_hash

SYMBOLS = "#*$%&|<>"
WINDOW = 5

_SYMBOL = np.zeros(256, np.int8)
_SYMBOL[[ord(c) for c in SYMBOLS]] = 1
COUNTERS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_STATS = ", ".join(f"{c} long" for c in COUNTERS)


def _same_text_before(key: np.ndarray) -> np.ndarray:
    """Which entries equal an earlier one."""
    order = np.argsort(key, kind="stable")
    again = np.zeros(len(key), bool)
    again[order[1:]] = key[order[1:]] == key[order[:-1]]
    return again


def text_stats(column: pa.Array) -> dict[str, np.ndarray]:
    """The base counters of each text, and its lines' normalised hashes."""
    t = Texts(column, "raw")
    letters = np.zeros(len(t.raw) + 1, np.int64)
    np.cumsum((t.raw & 0xC0) != 0x80, out=letters[1:])
    chars = t.per_words(letters[t.end] - letters[t.start])
    row_salt = mix(np.arange(1, t.n + 1, dtype=np.uint64))

    at, h = t.windows(WINDOW)
    key = h ^ row_salt[t.doc[at]]
    _, back, times = np.unique(key, return_inverse=True, return_counts=True)
    repeated = covered(len(t.hash), at[times[back] > 1], WINDOW)

    start, end, row = t.lines()
    first, last = np.searchsorted(t.start, start), np.searchsorted(t.start, end)
    full = last > first
    start, end, row, first, last = (x[full] for x in (start, end, row, first, last))
    raw_key = spans_hash(t.bytes_prefix, start, end) ^ row_salt[row]
    dup = np.bincount(row[_same_text_before(raw_key)], minlength=t.n)

    normal = Texts(column, "normal")
    line_hash = spans_hash(prefix_sum(normal.hash), first, last)
    return {
        "n_words": t.counts(),
        "word_chars": chars,
        "n_symbols": t.per_text(_SYMBOL[t.raw]),
        "n_dup_lines": dup,
        "n_repeat_words": t.per_words(repeated),
        "line_row": row,
        "line_hash": line_hash.view(np.int64),
    }


def measure(docs: DataFrame) -> DataFrame:
    """One row per document of (key, host, text): key, host, base counters, lines (hashes, one entry per distinct line)."""

    def run(batches):
        for batch in batches:
            for lo, hi in slices(batch.column(2)):
                part = batch.slice(lo, hi - lo)
                s = text_stats(part.column(2))
                # one entry for each distinct line of a text
                order = np.lexsort((s["line_hash"], s["line_row"]))
                row, h = s["line_row"][order], s["line_hash"][order]
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
                row, h = row[new], h[new]
                offsets = pa.array(np.searchsorted(row, np.arange(len(part) + 1 if len(part) else 1)), pa.int32())
                lines = pa.ListArray.from_arrays(offsets, pa.array(h, pa.int64()))
                numbers = [pa.array(s[c], pa.int64()) for c in COUNTERS]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *numbers, lines],
                    ["key", "host", *COUNTERS, "lines"],
                )

    host_type = docs.schema["host"].dataType.simpleString()
    return docs.select("key", "host", "text").mapInArrow(run, f"key long, host {host_type}, {_STATS}, lines array<long>")


def _cleaned(column: pa.Array, gone: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Each text without the lines whose hashes are in its list, and the number of its words that stay."""
    t, normal = Texts(column, "raw"), Texts(column, "normal")
    salt = mix(np.arange(1, t.n + 1, dtype=np.uint64))
    lists = pc.list_value_length(gone).fill_null(0).to_numpy(zero_copy_only=False)
    listed = np.asarray(pc.list_flatten(gone)).astype(np.int64).view(np.uint64) ^ np.repeat(salt, lists)
    start, end, row = t.lines()
    first, last = np.searchsorted(t.start, start), np.searchsorted(t.start, end)
    h = spans_hash(prefix_sum(normal.hash), first, last)
    out = (last > first) & np.isin(h ^ salt[row], listed)
    left = t.counts() - np.bincount(row[out], (last - first)[out], t.n).astype(np.int64)
    texts = column.to_pylist()
    for i in np.unique(row[out]).tolist():
        lo, hi = np.searchsorted(row, [i, i + 1])
        texts[i] = b"\n".join(t.raw[a:b].tobytes() for a, b in zip(start[lo:hi][~out[lo:hi]], end[lo:hi][~out[lo:hi]], strict=True)).decode()
    return pa.array(texts, pa.string()), left


def _without_lines(batches):
    for batch in batches:
        at = {c: batch.schema.get_field_index(c) for c in ("text", "gone")}
        rest = batch.drop_columns(["text", "gone"])
        for lo, hi in slices(batch.column(at["text"])):
            text, left = _cleaned(batch.column(at["text"]).slice(lo, hi - lo), batch.column(at["gone"]).slice(lo, hi - lo))
            part = rest.slice(lo, hi - lo)
            yield pa.RecordBatch.from_arrays([*part.columns, text, pa.array(left, pa.int64())], [*part.schema.names, "text", "words_left"])


def frequent_lines(texts: DataFrame, limits: list[tuple[int, float]]) -> DataFrame:
    """(host, h): the lines that reach one of the limits (texts, share of the host's texts), over distinct texts."""
    size = texts.groupBy(F.col("host").alias("of")).agg(F.count(F.lit(1)).alias("texts"))
    counts = texts.select("host", F.explode("lines").alias("h")).groupBy("host", "h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min(n for n, _ in limits))
    limit: Column = reduce(or_, [(F.col("n") >= n) & (F.col("n") >= F.col("texts") * share) for n, share in limits])
    return counts.join(size, counts["host"].eqNullSafe(size["of"])).where(limit).select("host", "h", "n")


def line_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    host: str = "source",
    text: str = "text",
    min_docs: int = 30,
    min_share: float = 0.005,
    keep_share: float = 0.3,
    keep_words: int = 10,
    some_docs: int = 11,
    least_docs: int = 5,
    small_share: float = 0.25,
) -> DataFrame:
    """Per document: base counters, lines_removed (distinct lines), words_left, ``kept`` (the method's verdict) and the text without the lines removed."""
    ship(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("id"), F.col(host).alias("host"), F.col(text).cast("string").alias("text"))
    src = src.withColumn("key", F.xxhash64(F.col("host").isNull(), "host", F.coalesce("text", F.lit(""))))
    # copies of a text meet first, so that a hot group of copies is one entry from here on;
    # narrow: counters and line hashes, cut here so that lines are parsed once
    texts = checkpointed(measure(src).groupBy("key").agg(*[F.any_value(c).alias(c) for c in ("host", *COUNTERS, "lines")]))
    frequent = frequent_lines(texts, [(min_docs, 0.0), (some_docs, min_share), (least_docs, small_share)]).select(F.col("host").alias("fh"), F.col("h").alias("fl"))
    gone = (
        texts.select("key", "host", F.explode("lines").alias("h"))
        .join(frequent, F.col("host").eqNullSafe(F.col("fh")) & (F.col("h") == F.col("fl")))
        .groupBy("key")
        .agg(F.collect_list("h").alias("gone"))
    )
    judged = texts.select("key", *COUNTERS).join(gone, "key", "left")
    # back to the texts: many rows of one key are split by the join, as the other side has one
    id_type = src.schema["id"].dataType.simpleString()
    rows = src.join(judged, "key").select("id", *COUNTERS, F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("lines_removed"), "text", "gone")
    out = rows.mapInArrow(_without_lines, f"id {id_type}, {_STATS}, lines_removed long, text string, words_left long")
    left = F.col("words_left")
    kept = (left >= keep_words) & (left >= F.col("n_words") * keep_share)
    return out.select(F.col("id").alias(id_col), *COUNTERS, "lines_removed", "words_left", kept.alias("kept"), F.col("text").alias(text))
