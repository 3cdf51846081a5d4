"""Ranked lexical search over an index whose strata are documents of equal length normaliser.

Terms are maximal runs of ASCII letters, digits and non-ASCII characters, A-Z
lower-cased.  One pass over the texts writes a forward index: for every document
its length n and its counts of the items' terms.  From it come N, L and df.  The
integer normaliser m depends on n alone, so documents of equal m form a stratum:
there a term's impact depends on its tf alone.

The forward index is range-sorted by m.  A task reads its strata in chunks of
bounded size and indexes each: postings by term and, within a term, by tf, the
largest first; impacts are computed once for each tf of a stratum.  The first
posting of a term bounds what any document of the stratum can get from it.  For
each item the strata are visited in the order of the sums of these bounds, until a
sum is below the item's k-th best score; results stay exact.  The k best of every
task meet in two steps of windows.

Items are worked off in blocks of bounded vocabulary (``BLOCK_TERMS``), each over
all documents, so the terms shipped to tasks have a bound however many items there are.

Defined cases: a null text has no term; a document without a term counts nowhere;
every row is a document, also if its id repeats; null ids come last among equal
scores; ids are integers; an item that is null or has no term gives no rows, every
item row is answered by itself; extra columns play no part; an empty table on
either side gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftgate.llm.store import checkpointed, ship, stash
from driftgate.llm.words import slices

BLOCK_TERMS = 200_000  # distinct terms of the items worked off together
BLOCK_ITEMS = 4_096
CHUNK_POSTINGS = 1_000_000
CHUNK_STRATA = 512
MERGE = 64  # parts in which the tasks' best meet first
LAST = np.iinfo(np.int64).max  # stands for a null id

_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def terms_of(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of a string column one after another, and the row of each."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    off = off - off[0]
    inside = _INSIDE[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[off] = True  # terms do not reach from one text into the next
    start = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate([[False], inside[:-1]])))
    end = np.flatnonzero(inside & (edge[1:] | ~np.concatenate([inside[1:], [False]]))) + 1
    cut = np.zeros(len(start) + 1, np.int64)
    np.cumsum(end - start, out=cut[1:])
    terms = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(cut), pa.py_buffer(_LOWER[raw[inside]])])
    return terms, np.searchsorted(off, start, "right") - 1


def _forward(vocabulary: pa.Array):
    """Rows (id, text) as (id, n, terms, tfs): the document's length and its counts of the vocabulary's terms."""
    size = len(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                part = batch.slice(lo, hi - lo)
                terms, row = terms_of(part.column(1))
                at = pc.index_in(terms, value_set=vocabulary)
                known = np.asarray(at.is_valid())
                key, tf = np.unique(row[known] * size + np.asarray(at.drop_null(), np.int64), return_counts=True)
                cut = pa.array(np.searchsorted(key, np.arange(len(part) + 1) * size), pa.int32())
                lists = [pa.ListArray.from_arrays(cut, pa.array(v.astype(np.int32))) for v in (key % size, tf)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.bincount(row, minlength=len(part)), pa.int64()), *lists], ["id", "n", "terms", "tfs"])

    return run


class Asked:
    """Items as flat arrays: item i has the terms ``term[cut[i]:cut[i+1]]``, weighted by w times their repeats."""

    def __init__(self, ids: list[int], counts: list[dict[int, int]], weight: np.ndarray):
        held = [(i, c) for i, c in enumerate(counts) if c]
        self.no = [i for i, _ in held]
        self.ids = [ids[i] for i in self.no]
        self.cut = np.cumsum([0, *(len(c) for _, c in held)])
        self.term = np.array([t for _, c in held for t in c], np.int64)
        self.worth = np.array([n for _, c in held for n in c.values()], np.int64) * weight[self.term] if held else np.zeros(0, np.int64)


class Best:
    """The k best (score, id) of each item so far; ``least`` is what a further score must reach."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.scores = [np.zeros(0, np.int64)] * n
        self.ids = [np.zeros(0, np.int64)] * n
        self.least = np.ones(n, np.int64)

    def add(self, i: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores[i], scores]), np.concatenate([self.ids[i], ids])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores[i], self.ids[i] = scores[order], ids[order]
        if len(order) == self.k:
            self.least[i] = self.scores[i][-1]


def visit(ids: np.ndarray, m: np.ndarray, size: np.ndarray, term: np.ndarray, tf: np.ndarray, asked: Asked, n_terms: int, best: Best) -> None:
    """Index one chunk (documents ordered by m; document i has ``size[i]`` postings) by strata and let every item visit them."""
    new = np.concatenate([[True], m[1:] != m[:-1]])
    strata = np.flatnonzero(new)
    stratum = np.cumsum(new) - 1
    row = np.repeat(np.arange(len(ids)), size)
    key = stratum[row] * n_terms + term
    order = np.lexsort((-tf, key))
    row, term, tf, key = row[order], term[order], tf[order], key[order]
    of = stratum[row]
    # one impact for each tf of a stratum
    most = int(tf.max()) + 1
    pair, back = np.unique(of * most + tf, return_inverse=True)
    t, norm = pair % most, m[strata][pair // most]
    impact = ((1_000_000_000 * t) // (1_000 * t + 12 * norm))[back]
    # postings of one term in one stratum; the first has the largest tf
    head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    tail = np.concatenate([head[1:], [len(key)]])
    lists = np.searchsorted(of[head], np.arange(len(strata) + 1))
    ends = np.concatenate([strata[1:], [len(ids)]])
    bound = np.zeros((len(strata), len(asked.ids)), np.int64)
    top = np.zeros(n_terms, np.int64)
    for s in range(len(strata)):
        h = head[lists[s] : lists[s + 1]]
        top[term[h]] = impact[h]
        bound[s] = np.add.reduceat(asked.worth * top[asked.term], asked.cut[:-1])
        top[term[h]] = 0
    place = np.full(n_terms, -1, np.int64)
    # each item's order of visits; strata are opened in rounds, the best of every item first
    orders = np.argsort(-bound, axis=0, kind="stable")
    for turn in range(len(strata)):
        by_stratum: dict[int, list[int]] = {}
        for i in np.flatnonzero(bound[orders[turn], np.arange(len(asked.ids))] >= best.least).tolist():
            by_stratum.setdefault(int(orders[turn, i]), []).append(i)
        if not by_stratum:
            break
        for s, items in by_stratum.items():
            h = slice(lists[s], lists[s + 1])
            place[term[head[h]]] = np.arange(lists[s], lists[s + 1])
            lo, hi = strata[s], ends[s]
            for i in items:
                q = slice(asked.cut[i], asked.cut[i + 1])
                at = place[asked.term[q]]
                worth, at = asked.worth[q][at >= 0], at[at >= 0]
                long = tail[at] - head[at]
                post = np.repeat(head[at] - np.concatenate([[0], np.cumsum(long)[:-1]]), long) + np.arange(long.sum())
                scores = np.zeros(hi - lo, np.int64)
                np.add.at(scores, row[post] - lo, impact[post] * np.repeat(worth, long))
                good = np.flatnonzero(scores >= best.least[i])
                if len(good):
                    best.add(i, scores[good], ids[lo:hi][good])
            place[term[head[h]]] = -1


def _search(asked: Asked, n_terms: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(asked.ids), k)
        held: list[tuple] = []
        postings = strata = 0

        def flush():
            if held:
                visit(*(np.concatenate(c) for c in zip(*held, strict=True)), asked, n_terms, best)
            held.clear()

        for batch in batches:
            ids = np.asarray(pc.fill_null(batch.column(0), int(LAST)), np.int64)
            m = np.asarray(batch.column(1), np.int64)
            size = np.asarray(pc.list_value_length(batch.column(2)), np.int64)
            cut = np.concatenate([[0], np.cumsum(size)])
            term, tf = (np.asarray(pc.list_flatten(batch.column(c)), np.int64) for c in (2, 3))
            lo = 0
            while lo < len(ids):
                hi = max(lo + 1, int(np.searchsorted(cut, cut[lo] + CHUNK_POSTINGS, "right")) - 1)
                held.append((ids[lo:hi], m[lo:hi], size[lo:hi], term[cut[lo] : cut[hi]], tf[cut[lo] : cut[hi]]))
                postings, strata = postings + int(cut[hi] - cut[lo]), strata + len(np.unique(m[lo:hi]))
                lo = hi
                if postings >= CHUNK_POSTINGS or strata >= CHUNK_STRATA:
                    flush()
                    postings = strata = 0
        flush()
        long = [len(s) for s in best.scores]
        flat = lambda parts: np.concatenate([np.zeros(0, np.int64), *parts])
        found = flat(best.ids)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.array(asked.no, np.int64), long), pa.int64()),
                pa.array(np.repeat(np.array(asked.ids, np.int64), long), pa.int64()),
                pa.array(found, pa.int64(), mask=found == LAST),
                pa.array(flat(best.scores), pa.int64()),
            ],
            ["no", "item_id", "doc_id", "score"],
        )

    return run


def _blocks(items: DataFrame, id_col: str, text: str) -> Iterator[tuple[list, list[dict[bytes, int]]]]:
    """The items in blocks of bounded vocabulary: ids, and how often each term stands in each item."""
    ids, counts, seen = [], [], set()
    for r in items.select(F.col(id_col).cast("long").alias("id"), F.col(text).cast("string").alias("text")).toLocalIterator():
        if r["id"] is None or r["text"] is None:
            continue
        count: dict[bytes, int] = {}
        for t in terms_of(pa.array([r["text"]], pa.large_string()))[0].to_pylist():
            count[t] = count.get(t, 0) + 1
        if ids and (len(seen | count.keys()) > BLOCK_TERMS or len(ids) == BLOCK_ITEMS):
            yield ids, counts
            ids, counts, seen = [], [], set()
        ids.append(r["id"])
        counts.append(count)
        seen |= count.keys()
    if ids:
        yield ids, counts


def _ranked(docs: DataFrame, ids: list, counts: list[dict[bytes, int]], k: int) -> DataFrame | None:
    """The best documents of one block of items: no, item_id, doc_id, score, rank."""
    names = sorted({t for c in counts for t in c})
    if not names:
        return None
    place = {t: i for i, t in enumerate(names)}
    vocabulary = pa.array(names, pa.large_binary())
    forward, _ = stash(docs.mapInArrow(_forward(vocabulary), "id long, n long, terms array<int>, tfs array<int>").where("n > 0"))
    total = forward.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
    if not total["docs"]:
        return None
    df = np.zeros(len(names), np.int64)
    for r in forward.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect():  # one number per term of the block
        df[r["t"]] = r["df"]
    weight = np.array([math.floor(1000 * math.log((2 * total["docs"] + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    asked = Asked(ids, [{place[t]: n for t, n in c.items()} for c in counts], weight)
    # 25 * n * N may pass 64 bits on its way
    m = F.expr(f"75 + (cast(25 * n as decimal(20, 0)) * cast({total['docs']} as decimal(18, 0))) div cast({total['terms']} as decimal(20, 0))")
    strata = forward.where(F.size("terms") > 0).select("id", m.alias("m"), "terms", "tfs")
    dealt = strata.repartitionByRange("m", F.xxhash64("id")).sortWithinPartitions("m")
    found = dealt.mapInArrow(_search(asked, len(names), k), "no long, item_id long, doc_id long, score long")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = F.pmod(F.xxhash64("doc_id"), F.lit(MERGE))
    some = found.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("no", "part").orderBy(*order))).where(F.col("rank") <= k)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("no").orderBy(*order))).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 20, doc_col: str = "doc_id", doc_text: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of every item row, by score, then by id."""
    spark = docs.sparkSession
    ship(spark)
    src = docs.select(F.col(doc_col).cast("long").alias("id"), F.col(doc_text).cast("string").alias("text"))
    found = []
    for ids, counts in _blocks(items, item_col, item_text):
        ranked = _ranked(src, ids, counts, k)
        if ranked is not None:
            found.append(checkpointed(ranked.select("item_id", "rank", "doc_id", "score")))
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.union, found)
