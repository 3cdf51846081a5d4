"""Exact quantiles against sorting, whatever the estimate says."""

from __future__ import annotations

import math
import random

import pytest

from driftgate.operators import quantiles
from driftgate.operators.metrics import numeric_summary
from driftgate.operators.quantiles import exact_quantiles

Q = ((1, 4), (1, 2), (3, 4), (0, 1), (1, 1), (999, 1000))


def by_rank(values, num, den):
    held = sorted((v for v in values if v is not None), key=lambda v: (math.isnan(v), v))
    return held[max(1, -(-num * len(held) // den)) - 1] if held else None


@pytest.mark.parametrize("accuracy", [2, 50, 10_000])
def test_exact_whatever_the_estimate(spark, accuracy):
    """An accuracy of 2 gives brackets that miss; a third of the rows is one value."""
    rng = random.Random(4)
    data = [(rng.choice([None, 7.0, rng.gauss(0, 1e6)]), rng.randint(-5, 5), rng.random() * 1e-300, float(i)) for i in range(5000)]
    df = spark.createDataFrame(data, "a double, b int, c double, d double").repartition(7)
    got = {(r.column_name, r.q): r.value for r in exact_quantiles(df, ["a", "b", "c", "d"], Q, accuracy).collect()}
    for i, c in enumerate("abcd"):
        for q, (num, den) in enumerate(Q):
            assert got[c, q] == by_rank([float(r[i]) if r[i] is not None else None for r in data], num, den), (c, q)


def test_nan_infinity_null_and_empty(spark):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame([(x, None) for x in (1.0, nan, -inf, inf, 2.0, None, -1e308, 1e308)], "a double, `n.x` double")
    got = {r.q: r.value for r in exact_quantiles(df, ["a", "n.x"], ((1, 7), (2, 7), (4, 7), (6, 7), (1, 1))).collect()}
    assert [got[i] for i in range(4)] == [-inf, -1e308, 2.0, inf] and math.isnan(got[4])
    assert exact_quantiles(df.limit(0), ["a"]).count() == 0
    empty = numeric_summary(df, ["n.x"]).first()
    assert (empty["count"], empty.p25, empty.max) == (0, None, None)


def test_only_a_bracket_is_ordered(spark, monkeypatch):
    """The windows of the plan stand over grouped values, and few buckets give the same."""
    df = spark.range(100_000).selectExpr("cast(pmod(id * 7919, 99991) as double) as x")
    summary = numeric_summary(df, ["x"])
    assert "percentile_approx" in summary._jdf.queryExecution().optimizedPlan().toString()
    want = summary.first()
    values = sorted(r.x for r in df.collect())
    assert (want.p25, want.p50, want.p75) == (values[24_999], values[49_999], values[74_999])
    monkeypatch.setattr(quantiles, "BUCKETS", 3)
    assert numeric_summary(df, ["x"]).first() == want
    rough = numeric_summary(df, ["x"], exact=False).first()
    assert abs(rough.p50 - want.p50) < 100
