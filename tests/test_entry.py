"""The driver contract of __spark_entry__."""

from __future__ import annotations

import __spark_entry__ as E


def test_every_query_has_a_twin():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert not set(E._reference_queries()) - set(E.oracle_sql())


def test_entry_schema(spark):
    df = E.entry(spark)
    assert df.columns == ["region", "total_orders", "unique_customers", "total_revenue", "avg_order_value"]
    rows = df.collect()
    assert len(rows) == 5 and all(r["avg_order_value"] < r["total_revenue"] for r in rows)


def test_queries_are_lazy(spark):
    """Building a query plans it but runs no job (iterative ones of the optional subpackage do)."""
    from tests.conftest import SF001

    sc = spark.sparkContext
    sc.setJobGroup("build-queries", "building the registered queries")
    try:
        for name, fn in E._reference_queries().items():
            if name in E.LANDING:
                continue
            assert fn(spark, SF001).columns, name
        assert list(sc.statusTracker().getJobIdsForGroup("build-queries")) == []
    finally:
        sc.setJobGroup("", "")
