"""Vector codes of four parts, assigned exactly with the help of pivots (LAESA).

Vectors become integers, ``floor(1024 * x)``, and are cut into four parts; each
part position has a codebook of 256 entries.  A few fixed pivots are chosen from
the first codebook, far from each other.  The distance of every part to every
pivot is computed once and written beside the part.  In each round only the
pivots' distances to the new entries are computed: their differences to the
written ones are lower bounds of the distance from part to entry.  The entries of
the lowest bounds are measured first; of the rest, only those whose bound does
not exceed the best so far.  All arithmetic is on integers, so the result is that
of measuring every entry.

A round is one pass over the written table: tasks sum their parts by entry, and
at most 4 x 256 sums meet on the driver.  Rows never move.

Defined cases: vectors that are null or hold a null or non-finite component are
dropped; the dimension is the most common one that four divides (ties: the
smaller), other vectors are dropped as well; null ids come last in the order
that picks the first entries, equal ids go by their vectors; with fewer than 256
vectors each is an entry; rows that repeat are kept each; labels may be null (one
group) and of any type; other columns are dropped; an empty table gives no rows.
Components beyond 65,536 would not fit 64-bit sums and are refused by an error.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftgate.llm.store import checkpointed, drop, ship, stash

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
PIVOTS = 8
FIRST = 8  # entries measured before the bounds decide
MOST = 65_536 * SCALE
STEP = 1_024  # rows at once: bounds and pairs of a step stay in cache


def integers(x: np.ndarray) -> np.ndarray:
    y = np.floor(x * SCALE)
    if y.size and np.abs(y).max() > MOST:
        raise ValueError(f"a vector component exceeds {MOST // SCALE}: its squares would not fit 64-bit sums")
    return y.astype(np.int64)


def root(squares: np.ndarray) -> np.ndarray:
    """The integer part of the square root, exactly."""
    r = np.sqrt(squares.astype(np.float64)).astype(np.int64)
    r -= r * r > squares
    r += (r + 1) * (r + 1) <= squares
    return r


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a to all rows of b."""
    return np.stack([((a - row) ** 2).sum(axis=1) for row in b], axis=1) if len(b) else np.zeros((len(a), 0), np.int64)


def choose_pivots(entries: np.ndarray, n: int) -> np.ndarray:
    """Entries far from the ones before: the first, then always the largest sum of distances."""
    chosen, total = [0], root(squared(entries, entries[:1]))[:, 0]
    while len(chosen) < min(n, len(entries)):
        total[chosen] = -1
        chosen.append(int(total.argmax()))
        total = total + root(squared(entries, entries[chosen[-1:]]))[:, 0]
    return entries[chosen]


def assign(x: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest entry of each row (ties: the lower index), its squared distance, and how many entries were measured."""
    marks = root(squared(entries, pivots))
    near, dist, measured = (np.zeros(len(x), np.int64) for _ in range(3))
    k = len(entries)
    for lo in range(0, len(x), STEP):
        rows, held = x[lo : lo + STEP], to_pivots[lo : lo + STEP]
        low = np.zeros((len(rows), k), np.int64)
        for p in range(held.shape[1]):
            np.maximum(low, np.abs(held[:, p, None] - marks[None, :, p]), out=low)
        # integer parts of two roots differ by less than one more than the roots do
        low = np.maximum(low - 1, 0)
        low *= low
        some = np.argpartition(low, FIRST - 1, axis=1)[:, :FIRST] if k > FIRST else np.broadcast_to(np.arange(k), (len(rows), k))
        best = ((rows[:, None, :] - entries[some]) ** 2).sum(axis=2).min(axis=1)
        at, entry = np.nonzero(low <= best[:, None])
        d = ((rows[at] - entries[entry]) ** 2).sum(axis=1)
        cut = np.searchsorted(at, np.arange(len(rows)))
        least = np.minimum.reduceat(d, cut)
        dist[lo : lo + STEP] = least
        near[lo : lo + STEP] = np.minimum.reduceat(np.where(d == least[at], entry, k), cut)
        measured[lo : lo + STEP] = np.bincount(at, minlength=len(rows))
    return near, dist, measured


def _numbers(column: pa.Array, width: int, kind: type) -> np.ndarray:
    return np.asarray(pc.list_flatten(column), kind).reshape(len(column), width) if len(column) else np.zeros((0, width), kind)


def _prepare(pivots: list[np.ndarray]):
    """Rows (id, label, v) with their integers and the distances of their parts to the pivots."""

    def run(batches):
        for batch in batches:
            n, d = len(batch), sum(p.shape[1] for p in pivots)
            x = integers(_numbers(batch.column(2), d, np.float64))
            w = d // PARTS
            marks = np.concatenate([root(squared(x[:, j * w : (j + 1) * w], p)) for j, p in enumerate(pivots)], axis=1)
            lists = [pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * a.shape[1], pa.int32()), pa.array(a.ravel().astype(np.int32))) for a in (x, marks)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists], ["id", "label", "x", "marks"])

    return run


def _assigned(batch: pa.RecordBatch, books: np.ndarray, pivots: list[np.ndarray]):
    """For each part of a batch: its integers and what ``assign`` says."""
    w, p = books.shape[2], len(pivots[0])
    x = _numbers(batch.column(batch.schema.get_field_index("x")), PARTS * w, np.int64)
    marks = _numbers(batch.column(batch.schema.get_field_index("marks")), PARTS * p, np.int64)
    for j in range(PARTS):
        part = x[:, j * w : (j + 1) * w]
        yield part, *assign(part, marks[:, j * p : (j + 1) * p], books[j], pivots[j])


def _sums(books: np.ndarray, pivots: list[np.ndarray]):
    """One row for each entry that a task's parts are nearest to: part, entry, count, sums."""

    def run(batches):
        total, count = np.zeros_like(books), np.zeros(books.shape[:2], np.int64)
        for batch in batches:
            for j, (part, near, _, _) in enumerate(_assigned(batch, books, pivots)):
                np.add.at(total[j], near, part)
                count[j] += np.bincount(near, minlength=books.shape[1])
        j, e = np.nonzero(count)
        cols = [pa.array(j, pa.int32()), pa.array(e, pa.int32()), pa.array(count[j, e]), *(pa.array(c) for c in total[j, e].T)]
        yield pa.RecordBatch.from_arrays(cols, ["part", "entry", "n", *(f"s{i}" for i in range(books.shape[2]))])

    return run


def _codes(books: np.ndarray, pivots: list[np.ndarray]):
    def run(batches):
        for batch in batches:
            code, error, measured = [], 0, 0
            for _, near, dist, seen in _assigned(batch, books, pivots):
                code.append(near)
                error, measured = error + dist, measured + seen
            text = [bytes(row).hex() for row in np.stack(code, axis=1).astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array(error, pa.int64()), pa.array(measured, pa.int64())],
                ["id", "label", "code", "error", "measured"],
            )

    return run


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def kept_vectors(vectors: DataFrame, id_col: str, vector: str, label: str) -> tuple[DataFrame, int]:
    """(id, label, v) of the rows that take part, and their dimension (0: none)."""
    v = F.col("v")
    src = vectors.select(F.col(id_col).alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("v"))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    src = src.where(v.isNotNull() & F.coalesce(fine, F.lit(False)) & (F.size(v) > 0) & (F.size(v) % PARTS == 0))
    most = src.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    d = most[0]["d"] if most else 0
    return src.where(F.size(v) == d), d


def compress(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label") -> tuple[DataFrame, np.ndarray]:
    """(id, label, code, error, measured) of every kept vector, and the final codebooks by part, entry and place."""
    spark = vectors.sparkSession
    ship(spark)
    rows, d = kept_vectors(vectors, id_col, vector, label)
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("id", "label")}
    out = f"id {kinds['id']}, label {kinds['label']}, code string, error long, measured long"
    first = rows.orderBy(F.asc_nulls_last("id"), "v").limit(ENTRIES).select("v").collect() if d else []
    if not first:
        return spark.createDataFrame([], out), np.zeros((PARTS, 0, 0), np.int64)
    start = integers(np.array([r["v"] for r in first], np.float64))
    books = np.stack(np.split(start, PARTS, axis=1))
    pivots = [choose_pivots(b, PIVOTS) for b in books]
    table, path = stash(rows.mapInArrow(_prepare(pivots), f"id {kinds['id']}, label {kinds['label']}, x array<int>, marks array<int>"))
    names = [f"s{i}" for i in range(d // PARTS)]
    for _ in range(ROUNDS):
        sums = table.select("x", "marks").mapInArrow(_sums(books, pivots), "part int, entry int, n long, " + ", ".join(f"{s} long" for s in names))
        books = books.copy()
        for r in sums.groupBy("part", "entry").agg(*[F.sum(c).alias(c) for c in ("n", *names)]).collect():  # one row per entry
            books[r["part"], r["entry"]] = np.array([r[s] for s in names], np.int64) // r["n"]
    done = checkpointed(table.mapInArrow(_codes(books, pivots), out))
    drop(spark, path)
    return done, books


def coded(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Every kept vector's code, its error, the error summed over its label, the codebooks' digest, and the entries measured for it."""
    done, books = compress(vectors, id_col, vector, label)
    # one row per label comes back to the rows; a label of very many rows is summed by every task first
    by_label = done.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    joined = done.join(by_label, done["label"].eqNullSafe(by_label["of"]))
    return joined.select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
