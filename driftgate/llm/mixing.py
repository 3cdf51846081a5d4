"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight schedule over training time 0..1, piecewise linear
in its knots.  Its integral is the source's share; a share is capped at
``most`` times the source's size, and the excess is shared again by weight until no
source is above.  A source's documents, in hash order, form a stream that
repeats; the mix takes the stream up to the target (a document is in if its
middle is).  A copy that starts at fraction q of its source's demand is used at
the time t where the integral of the schedule up to t is q: the cumulative
demand is inverted in closed form.  The training position is the number of
tokens all sources demand up to t, and the mix is range-sorted by position.

Running sums inside a source are two-level: documents fall into buckets by a
hash of id and text, bucket totals are summed along the source, and rows inside
one bucket; no task ever holds a source, or a hot id.  Rows without a word need
no place in the stream and are dealt over all buckets.  One row per source goes through the driver, to lay out
the schedule; a mix names its sources, and more than ``MOST_SOURCES`` is an error.

Defined cases: null text has size 0 and is never taken; the null source is a
source of its own and comes last; equal hash order is broken by id, then size;
rows that repeat id and text are rows of their own, neighbours in the stream
(one bucket, whose window spills); an empty table, or one without words,
gives no copies.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftgate.llm.store import checkpointed

#: A knot list [(time, weight), ...]; times grow from 0 to 1.
Schedule = list[tuple[float, float]]
MOST_SOURCES = 100_000
BUCKET_ROWS = 2_000
_OWN = "_mix_"


def cycling(weights: tuple[float, ...] = (5, 2, 1), tilt: float = 0.5) -> Callable[[int], Schedule]:
    """Schedules by a source's rank: weights repeat; every other source rises, the rest fall, around its weight."""

    def of(rank: int) -> Schedule:
        w = weights[rank % len(weights)]
        s = tilt if rank % 2 else -tilt
        return [(0.0, w * (1 - s)), (0.5, float(w)), (1.0, w * (1 + s))]

    return of


def integral(schedule: Schedule) -> float:
    return sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(schedule, schedule[1:], strict=False))


def targets(sizes: list[int], weights: list[float], most: float = 3.0) -> list[float]:
    """Shares of the total by weight, capped at ``most`` times each size, the excess shared again by weight."""
    total, cap = float(sum(sizes)), [most * s for s in sizes]
    out, open_ = [0.0] * len(sizes), {i for i, w in enumerate(weights) if w > 0}
    while open_:
        rest = total - sum(out)
        unit = rest / sum(weights[i] for i in open_)
        above = {i for i in open_ if weights[i] * unit >= cap[i]}
        if not above:
            for i in open_:
                out[i] = weights[i] * unit
            break
        for i in above:
            out[i] = cap[i]
        open_ -= above
    return out


def word_count(text):
    """Words of a text column, as a column."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def plan(totals: DataFrame, schedule_of: Callable[[int], Schedule], most: float) -> DataFrame:
    """One row per source of ``totals`` (source, size): its size, target, and the knots of its schedule."""
    spark = totals.sparkSession
    found = totals.limit(MOST_SOURCES + 1).collect()
    if len(found) > MOST_SOURCES:
        raise ValueError(f"a mix of more than {MOST_SOURCES} sources; name fewer")
    found.sort(key=lambda r: (r["source"] is None, r["source"]))
    schedules = [schedule_of(i) for i in range(len(found))]
    sizes = [int(r["size"] or 0) for r in found]
    want = targets(sizes, [integral(s) for s in schedules], most)
    # all sources' knots, so that every schedule is linear between neighbouring ones
    times = sorted({t for s in schedules for t, _ in s})
    rows, total_at = [], np.zeros(len(times))
    for r, n, t, s in zip(found, sizes, want, schedules, strict=True):
        rate = np.interp(times, *zip(*s, strict=True))
        share = np.concatenate([[0.0], np.cumsum(np.diff(times) * (rate[1:] + rate[:-1]) / 2)])
        whole = share[-1] if share[-1] > 0 else 1.0
        rate, share = rate / whole, share / whole
        total_at += t * share
        rows.append([r["source"], n, float(t), rate.tolist(), share.tolist()])
    # demand of the whole mix at each knot and its rate there
    all_rate = (np.sum([np.array(x[3]) * x[2] for x in rows], axis=0) if rows else np.zeros(len(times))).tolist()
    kind = totals.schema["source"].dataType.simpleString()
    fields = f"{_OWN}of {kind}, {_OWN}source_size long, {_OWN}target double, {_OWN}rate array<double>, {_OWN}share array<double>, {_OWN}times array<double>, {_OWN}all_rate array<double>, {_OWN}all_at array<double>"
    return spark.createDataFrame([tuple([*x, [float(t) for t in times], all_rate, total_at.tolist()]) for x in rows], fields)


def mix(docs: DataFrame, schedule_of: Callable[[int], Schedule] | None = None, id_col: str = "doc_id", source: str = "source", text: str = "text", most: float = 3.0) -> DataFrame:
    """All columns of ``docs`` and size, source_size, target, copies, positions: per row, the copies taken and where each is used.

    Output columns replace columns of these names.  ``ordered`` turns the rows
    into one row per copy in training order.
    """
    buckets = max(1, docs.count() // BUCKET_ROWS)
    h = F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.col(text), F.lit(0x5EED)), 1)  # buckets and rows in one order
    size = word_count(F.col(text).cast("string"))
    hashed = F.floor(F.shiftright(h, 32) / F.lit(float(1 << 31)) * buckets).cast("int")
    bucket = F.when(size > 0, hashed).otherwise(F.pmod(F.monotonically_increasing_id(), F.lit(buckets)).cast("int"))
    rows = docs.withColumns({"size": size, f"{_OWN}h": h, f"{_OWN}b": bucket})
    # one row for each source and bucket
    sums = checkpointed(rows.groupBy(F.col(source).alias("source"), F.col(f"{_OWN}b").alias("b")).agg(F.sum("size").alias("size")))
    sources = plan(sums.groupBy("source").agg(F.sum("size").alias("size")), schedule_of or cycling(), most)
    along = Window.partitionBy("source").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(F.col("source").alias(f"{_OWN}s"), F.col("b").alias(f"{_OWN}sb"), F.coalesce(F.sum("size").over(along), F.lit(0)).alias(f"{_OWN}before"))
    inner = Window.partitionBy(source, f"{_OWN}b").orderBy(f"{_OWN}h", id_col, "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn(f"{_OWN}in", F.coalesce(F.sum("size").over(inner), F.lit(0)))
    rows = rows.join(before, F.col(source).eqNullSafe(F.col(f"{_OWN}s")) & (F.col(f"{_OWN}b") == F.col(f"{_OWN}sb")), "left")
    rows = rows.withColumn(f"{_OWN}at", F.coalesce(f"{_OWN}before", F.lit(0)) + F.col(f"{_OWN}in"))
    rows = rows.join(sources, F.col(source).eqNullSafe(F.col(f"{_OWN}of")))
    c = lambda n: F.col(f"{_OWN}{n}")
    passes = F.sequence(F.lit(0), F.lit(int(most)))
    taken = F.filter(passes, lambda k: (k * c("source_size") + c("at") + F.col("size") / 2.0) < c("target"))
    taken = F.when(F.col("size") > 0, taken).otherwise(F.array().cast("array<int>"))
    fraction = F.transform(taken, lambda k: F.least((k * c("source_size") + c("at")) / c("target"), F.lit(1.0)))
    rows = rows.withColumn(f"{_OWN}q", fraction)
    return (
        rows.withColumn("source_size", c("source_size"))
        .withColumn("target", c("target"))
        .withColumn("copies", F.size(c("q")))
        .withColumn("positions", F.transform(c("q"), lambda q: _position(q)))
        .drop(*[f"{_OWN}{x}" for x in ("of", "source_size", "target", "rate", "share", "times", "all_rate", "all_at", "at", "q", "h", "b", "in", "s", "sb", "before")])
    )


def _position(q):
    """The mix's cumulative demand at the time where the source's own is the fraction q."""
    c = lambda n: F.col(f"{_OWN}{n}")
    at = lambda a, i: F.element_at(c(a), i)
    # the last knot (from 1) whose share does not exceed q, but not the final knot
    i = F.least(F.greatest(F.size(F.filter(c("share"), lambda s: s <= q)), F.lit(1)), F.size(c("share")) - 1)
    width = at("times", i + 1) - at("times", i)
    r0, slope = at("rate", i), (at("rate", i + 1) - at("rate", i)) / width
    need = q - at("share", i)
    # need = r0 x + slope x^2 / 2, solved for x without cancellation
    root = F.sqrt(F.greatest(r0 * r0 + 2 * slope * need, F.lit(0.0)))
    x = F.least(F.when(need > 0, 2 * need / (r0 + root)).otherwise(F.lit(0.0)), width)
    g0, g_slope = at("all_rate", i), (at("all_rate", i + 1) - at("all_rate", i)) / width
    return at("all_at", i) + g0 * x + g_slope * x * x / 2


def ordered(mixed: DataFrame, partitions: int | None = None) -> DataFrame:
    """One row per copy, range-sorted by training position."""
    one = mixed.withColumn("position", F.explode("positions")).drop("positions")
    spread = one.repartitionByRange(partitions, "position") if partitions else one.repartitionByRange("position")
    return spread.sortWithinPartitions("position")
