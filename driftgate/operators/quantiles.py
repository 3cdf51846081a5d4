"""Exact quantiles of many columns by distributed selection (M4).

The q-quantile of n values is the one of rank ceil(q * n), as SQL's
``percentile_disc``.  Nothing is sorted as a whole:

1. one aggregate brackets every quantile by ``percentile_approx`` a little
   below and above it (bounded memory per task);
2. a second one counts the values below and up to each bracket.  Should a
   bracket miss its rank, the column's whole range takes its place, so the
   result never depends on the estimate;
3. only the values inside a bracket (a few in ten thousand) are grouped by
   value with their counts, combined map-side; they are counted by ``BUCKETS``
   equal ranges, and only the range that holds the rank is ordered.

All of it is one lazy plan: the one-row results go into the next step as scalar
subqueries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 4096


def _rank(num: int, den: int, n: Column) -> Column:
    return F.greatest(F.lit(1), F.call_function("div", F.lit(num) * n + F.lit(den - 1), F.lit(den)))


def exact_quantiles(df: DataFrame, columns: Sequence[str], quantiles: Sequence[tuple[int, int]] = ((1, 4), (1, 2), (3, 4)), accuracy: int = 10_000) -> DataFrame:
    """``(column_name, q, value)``: for each column and fraction (numerator, denominator) the exact quantile, ``q`` its place in ``quantiles``.

    NULLs are left out; NaN counts as the largest value; a column without a
    value has no row.
    """
    if not columns:
        return df.sparkSession.createDataFrame([], "column_name string, q int, value double")
    values = df.select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(columns)])
    goals = [(i, q) for i in range(len(columns)) for q in range(len(quantiles))]
    slack = 2.0 / accuracy
    around = [f for num, den in quantiles for f in (max(0.0, num / den - slack), min(1.0, num / den + slack))]
    aggs = []
    for i in range(len(columns)):
        x = F.col(f"x{i}")
        aggs += [F.count(x).alias(f"n{i}"), F.min(x).alias(f"least{i}"), F.max(x).alias(f"most{i}"), F.percentile_approx(x, around, accuracy).alias(f"a{i}")]
    # each one-row result is attached once, as a column: a subquery of many mentions would be planned many times
    guess = values.agg(*aggs).select(F.struct("*").alias("g"))
    guessed = values.select("*", guess.scalar().alias("g"))

    # brackets that hold their rank, else the whole range
    g = F.col("g")
    counted = [x for i, q in goals for x in (F.count_if(F.col(f"x{i}") < g[f"a{i}"][2 * q]).alias(f"b{i}_{q}"), F.count_if(F.col(f"x{i}") <= g[f"a{i}"][2 * q + 1]).alias(f"e{i}_{q}"))]
    counts = guessed.agg(F.any_value("g").alias("g"), *counted)
    cells = []
    for i, q in goals:
        rank, below = _rank(*quantiles[q], g[f"n{i}"]), F.col(f"b{i}_{q}")
        held = (below < rank) & (rank <= F.col(f"e{i}_{q}"))
        lo, hi = F.when(held, g[f"a{i}"][2 * q]).otherwise(g[f"least{i}"]), F.when(held, g[f"a{i}"][2 * q + 1]).otherwise(g[f"most{i}"])
        cells.append(F.struct(lo.alias("lo"), hi.alias("hi"), (rank - F.when(held, below).otherwise(F.lit(0))).alias("rank")))
    brackets = counts.select(F.array(*cells).alias("b"))
    bracketed = values.select("*", brackets.scalar().alias("b"))
    inside = []
    for at, (i, _) in enumerate(goals):
        x, b = F.col(f"x{i}"), F.col("b")[at]
        inside.append(F.when(x.between(b["lo"], b["hi"]), F.struct(F.lit(at).alias("goal"), x.alias("value"), b["lo"].alias("lo"), b["hi"].alias("hi"), b["rank"].alias("rank"))))
    held = bracketed.select(F.inline(F.array_compact(F.array(*inside)))).groupBy("goal", "value", "lo", "hi", "rank").agg(F.count(F.lit(1)).alias("n"))
    share = F.nanvl((F.col("value") - F.col("lo")) / F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0)), F.lit(0.0))
    bucket = F.least(F.lit(BUCKETS - 1), F.greatest(F.lit(0), F.coalesce(F.floor(share * BUCKETS).cast("int"), F.lit(0))))
    held = held.select("goal", "value", "rank", "n", bucket.alias("bucket"))
    # the range that holds the rank: at most BUCKETS rows a goal
    order = Window.partitionBy("goal").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranges = held.groupBy("goal", "rank", "bucket").agg(F.sum("n").alias("total")).withColumn("upto", F.sum("total").over(order))
    hit = ranges.where((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("total") < F.col("rank"))).select("goal", "bucket", (F.col("rank") - F.col("upto") + F.col("total")).alias("left"))
    inner = Window.partitionBy("goal").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    picked = held.join(hit, ["goal", "bucket"]).withColumn("upto", F.sum("n").over(inner))
    found = picked.where((F.col("upto") >= F.col("left")) & (F.col("upto") - F.col("n") < F.col("left")))
    named = F.element_at(F.array(*[F.lit(columns[i]) for i, _ in goals]), F.col("goal") + 1)
    return found.select(named.alias("column_name"), F.element_at(F.array(*[F.lit(q) for _, q in goals]), F.col("goal") + 1).alias("q"), "value")
