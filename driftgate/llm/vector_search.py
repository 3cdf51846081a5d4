"""Approximate nearest neighbours by cosine: inverted lists with an adaptive dimension scan.

Rows fall into lists by their nearest centroid; centroids are fitted on a
bounded sample, and so is the number of lists to probe (``recall`` of the
sample's own neighbours lie in them); every row is indexed.  Inside a probed list, vectors are unit
vectors under a random rotation, so that any first d of D columns are a random
projection.  The scan goes by column blocks: after each block, a hypothesis
test on the partial distance (scaled by D / d, with slack ``EPSILON`` / sqrt d)
abandons candidates that cannot reach the current k-th best; survivors are
scored exactly, in double precision on the original vectors.

Lists larger than ``BLOCK_ROWS`` are split by a hash of the id into blocks that
are searched apart, so a very common vector is no hot task.  Queries are
distributed with the blocks they probe; a list asked by more than
``ASKED_ROWS`` queries has them split by a hash, and each part meets the list's
blocks apart.  A query's best of each block meet in one window of ``k`` rows
per block.

Defined cases: vectors that are null, zero, of another dimension than most, or
hold a null or non-finite component take no part, nor do null ids; rows that
repeat an id and its vector are one row, as a query and as a candidate; rows of
one id with different vectors are queries of their own, told apart by
``query_key``; candidates with the query's id are its own and are left out
before the scan; ties go to the smaller id; fewer candidates than k give them
all; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftgate.llm.store import checkpointed, ship

SAMPLE = 20_000
MOST_LISTS = 1_024
BLOCK_ROWS = 4_096
ASKED_ROWS = 65_536
COLUMNS = 16
EPSILON = 2.1
FIRST = 64
SLACK = 1e-6
DENSE = 0.25  # candidates alive below which the scan goes on pair by pair
PAIRS = 2_000_000  # of queries and rows in one step


def usable(vectors: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(id, v): the different rows that take part, v as an array of doubles."""
    v = F.col("v")
    src = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    some = F.exists(v, lambda x: x != 0)
    src = src.where(F.col("id").isNotNull() & v.isNotNull() & F.coalesce(fine, F.lit(False)) & F.coalesce(some, F.lit(False)))
    size = src.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    return src.where(F.size("v") == (size[0]["d"] if size else 0)).dropDuplicates(["id", "v"])


def _matrix(column: pa.Array) -> np.ndarray:
    flat = np.asarray(column.flatten(), np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def rotation(d: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(13).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def centroids(sample: np.ndarray, lists: int) -> np.ndarray:
    """Spherical k-means on the sample."""
    rng = np.random.default_rng(17)
    c = sample[rng.choice(len(sample), lists, replace=False)]
    for _ in range(8):
        near = (sample @ c.T).argmax(axis=1)
        total = np.zeros_like(c)
        np.add.at(total, near, sample)
        norm = np.sqrt((total * total).sum(axis=1, keepdims=True))
        c = np.where(norm > 1e-12, total / np.maximum(norm, 1e-12), c)
    return c


def fit(rows: DataFrame, n: int, k: int, recall: float) -> tuple[np.ndarray, int]:
    """Centroids and the number of lists to probe, from the sample."""
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").collect()
    x = _unit(np.array([r["v"] for r in sample], np.float64))
    centers = centroids(x, max(1, min(MOST_LISTS, len(x), round(math.sqrt(n)))))
    return centers, probes_needed(x, centers, k, recall)


def _assign(centers: np.ndarray):
    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(1))
            near = (_unit(x) @ centers.T).argmax(axis=1) if len(x) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(near, pa.int32()), pa.array([r.tobytes() for r in x], pa.binary())], ["id", "list", "v"])

    return run


def _nearest_lists(x: np.ndarray, centers: np.ndarray, sizes: np.ndarray, probes: int, enough: int) -> list[np.ndarray]:
    """Each query's lists: the nearest, at least ``probes`` and until they hold ``enough`` rows."""
    order = np.argsort(-(_unit(x) @ centers.T), axis=1, kind="stable")
    held = np.cumsum(sizes[order], axis=1)
    return [lists[: max(probes, int(np.searchsorted(total, enough)) + 1)] for lists, total in zip(order, held, strict=True)]


def _asked(centers: np.ndarray, *how):
    """How many queries of a batch probe each list."""

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(1))
            if len(x):
                times = np.bincount(np.concatenate(_nearest_lists(x, centers, *how)), minlength=len(centers))
                some = np.flatnonzero(times)
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(times[some], pa.int64())], ["list", "n"])

    return run


def _probe(centers: np.ndarray, blocks: np.ndarray, splits: np.ndarray, *how):
    """One row for each query and block of a list it probes, in the query's split of the list."""

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(1))
            if not len(x):
                continue
            out: list[list] = [[], [], [], [], [], []]
            for name, key, row, lists in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), x, _nearest_lists(x, centers, *how), strict=True):
                data = row.tobytes()
                for li in lists.tolist():
                    for b in range(int(blocks[li])):
                        for column, value in zip(out, (name, key, li, b, key % int(splits[li]), data), strict=True):
                            column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], ["id", "key", "list", "part", "split", "v"])

    return run


def _search(k: int):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        get = lambda t: (np.asarray(t.column("id").combine_chunks(), np.int64), np.array([np.frombuffer(v.as_py()) for v in t.column("v")]))
        out: list[list] = [[], [], [], []]
        if len(rows) and len(queries):
            ids, x = get(rows)
            q_ids, q = get(queries)
            q_keys = queries.column("key").to_pylist()
            order = np.argsort(ids, kind="stable")
            ids, x = ids[order], x[order]
            r = rotation(x.shape[1])
            turned = np.ascontiguousarray((_unit(x) @ r).T)  # by columns
            norms = np.sqrt((x * x).sum(axis=1))
            turns = _unit(q) @ r
            own = np.stack([np.searchsorted(ids, q_ids, side) for side in ("left", "right")], axis=1)
            group = max(1, PAIRS // len(ids))
            for lo in range(0, len(q), group):
                rows_of = scan(turned, turns[lo : lo + group], k, own[lo : lo + group])
                for name, key, v, at in zip(q_ids[lo:], q_keys[lo:], q[lo:], rows_of, strict=False):
                    score = (x[at] * v).sum(axis=1) / (norms[at] * np.sqrt((v * v).sum()))
                    best = np.lexsort((ids[at], -score))[:k]
                    out[0].extend([name] * len(best))
                    out[1].extend([key] * len(best))
                    out[2].extend(ids[at][best].tolist())
                    out[3].extend(score[best].tolist())
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64()]
        return pa.table([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], ["query_id", "query_key", "vec_id", "score"])

    return run


def scan(turned: np.ndarray, queries: np.ndarray, k: int, own: np.ndarray) -> list[np.ndarray]:
    """For each query, the rows (columns of ``turned``) that may be among its k nearest, by the adaptive dimension scan.

    ``own``: for each query the first row that is its own and the first after these.
    """
    d, n = turned.shape
    at = np.arange(n)
    other = (at < own[:, :1]) | (at >= own[:, 1:])
    head = min(n, max(FIRST, k))
    far = np.where(other[:, :head], 2 - 2 * (queries @ turned[:, :head]), np.inf)  # unit vectors
    limit = np.partition(far, k - 1, axis=1)[:, k - 1] if head >= k else np.full(len(queries), np.inf)
    # dense partial distances while most candidates live, then pairs
    partial = np.zeros((len(queries), n))
    pairs = None
    for c in range(0, d, COLUMNS):
        e = min(c + COLUMNS, d)
        slack = (1 + EPSILON / math.sqrt(e)) ** 2 if e < d else 1.0  # the test: would the whole distance exceed the limit?
        bound = limit * slack * (e / d) + SLACK
        block, q = turned[c:e], queries[:, c:e]
        if pairs is None:
            partial += (q * q).sum(axis=1)[:, None] + (block * block).sum(axis=0)[None] - 2 * (q @ block)
            alive = (partial <= bound[:, None]) & other
            if np.count_nonzero(alive) < DENSE * alive.size or e == d:
                pairs = np.nonzero(alive)
                partial = partial[pairs]
        else:
            partial = partial + ((q[pairs[0]] - block[:, pairs[1]].T) ** 2).sum(axis=1)
            ok = partial <= bound[pairs[0]]
            pairs, partial = (pairs[0][ok], pairs[1][ok]), partial[ok]
    cut = np.searchsorted(pairs[0], np.arange(len(queries) + 1))
    out = []
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        at, dist = pairs[1][a:b], partial[a:b]
        if len(dist) > k:
            at = at[dist <= np.partition(dist, k - 1)[k - 1] + SLACK]
        out.append(at)
    return out


def probes_needed(sample: np.ndarray, centers: np.ndarray, k: int, recall: float) -> int:
    """Nearest lists to probe so that, inside the sample, this share of the true neighbours lies in them."""
    asked = sample[: min(400, len(sample))]
    score = asked @ sample.T
    score[np.arange(len(asked)), np.arange(len(asked))] = -2
    near = np.argsort(-score, axis=1)[:, : min(k, len(sample) - 1)]
    place = np.argsort(np.argsort(-(asked @ centers.T), axis=1, kind="stable"), axis=1)
    rank = np.take_along_axis(place, (sample @ centers.T).argmax(axis=1)[near], axis=1)
    return int(np.quantile(rank, recall)) + 1 if rank.size else len(centers)


def nearest(vectors: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vector: str = "embedding", recall: float = 0.98) -> DataFrame:
    """query_id, rank, vec_id, score, query_key: the k nearest rows found for each row for which ``queries`` (over ``id``) holds.

    ``query_key`` is a hash of the query's vector; it tells rows of one id apart.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = checkpointed(usable(vectors, id_col, vector))
    n = rows.count()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double, query_key long")
    centers, probes = fit(rows, n, k, recall)
    index = checkpointed(rows.mapInArrow(_assign(centers), "id long, list int, v binary"))
    sizes = _per_list(index.groupBy("list").agg(F.count(F.lit(1)).alias("n")), len(centers))
    blocks = np.maximum(1, -(-sizes // BLOCK_ROWS))
    how = (sizes, probes, 20 * k)
    asking = rows.where(queries).select("id", "v", F.xxhash64("v").alias("key"))
    asked = _per_list(asking.mapInArrow(_asked(centers, *how), "list int, n long").groupBy("list").agg(F.sum("n").alias("n")), len(centers))
    splits = np.maximum(1, -(-asked // ASKED_ROWS))
    of_list = lambda a: F.element_at(F.lit(a.tolist()), F.col("list") + 1)
    # a hot id's different vectors spread over the blocks, too
    parted = index.withColumn("part", F.pmod(F.xxhash64("id", "v"), of_list(blocks)).cast("int"))
    parted = parted.withColumn("split", F.explode(F.sequence(F.lit(0), of_list(splits).cast("int") - 1)))
    probing = asking.mapInArrow(_probe(centers, blocks, splits, *how), "id long, key long, list int, part int, split int, v binary")
    spot = ["list", "part", "split"]
    found = parted.groupBy(*spot).cogroup(probing.groupBy(*spot)).applyInArrow(_search(k), "query_id long, query_key long, vec_id long, score double")
    best = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score", "query_key")


def _per_list(counts: DataFrame, lists: int) -> np.ndarray:
    """One number per list."""
    out = np.zeros(lists, np.int64)
    for r in counts.collect():
        out[r["list"]] = r["n"]
    return out
