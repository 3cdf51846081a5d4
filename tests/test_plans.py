"""Plan shape: what keeps the registered queries scalable, checked on the physical plans."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from driftgate.operators.rules import Rule
from driftgate.operators.schema_diff import infer_batch_types
from driftgate.operators.validate import validate

from tests.conftest import SF001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(E.queries().keys()))
def test_no_cartesian_or_nested_loop(spark, name):
    plan = _plan(E.queries()[name](spark, SF001))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_unique_uses_aggregate_not_window(spark):
    df = spark.read.parquet(f"{SF001}/lineitem.parquet").select(F.col("l_orderkey").alias("k"), "l_partkey")
    plan = _plan(validate(df, [Rule.unique("k")]).flagged)
    assert "Window" not in plan
    assert "HashAggregate" in plan  # row-id order: a plain min, hash-based, combined map-side


def test_batch_inference_is_hash_aggregate(spark):
    df = spark.read.parquet(f"{SF001}/orders.parquet").select(
        F.col("o_orderdate").cast("date").alias("batch"), F.col("o_orderpriority"), F.col("o_totalprice").cast("string")
    )
    plan = _plan(infer_batch_types(df, "batch"))
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_filters_and_pruning_reach_the_scan(spark, tmp_dir):
    plan = _plan(E.queries()["revenue_by_day"](spark, SF001))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_orderdate" in plan
    # on the partitioned clean table a date range prunes partitions (see test_analytics_tables too)
    clean = E.O.clean_orders(spark, SF001)
    clean.write.partitionBy("year", "month", "day").parquet(tmp_dir + "/clean")
    q = E.A.daily_trend_30d(spark.read.parquet(tmp_dir + "/clean"), E.O.AS_OF)
    p = _plan(q)
    assert "PartitionFilters: [isnotnull(year" in p or "PartitionFilters: [(" in p
