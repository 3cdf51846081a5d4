"""Reprocessing the quarantine is a batch that may break off anywhere."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from driftgate.operators.rules import RuleSet, orders_rules
from driftgate.plans import tables as T
from driftgate.plans.orders import ORDERS_SCHEMA
from driftgate.plans.pipeline import read_layer, run_batch, run_summary
from driftgate.settings import TableSpec
from driftgate.sources.files import read_raw

from tests.fixtures import HEADER, invalid_rows, write_csv

RELAXED = RuleSet(tuple(r for r in orders_rules() if r.name != "quantity_positive"))


def _lake(spark, root: str) -> TableSpec:
    spec = TableSpec("orders", root, ORDERS_SCHEMA)
    run_batch(spark, read_raw(spark, write_csv(root + "/in", "c.csv", HEADER, invalid_rows())), spec, orders_rules(), "r1")
    return spec


def _layers(spark, spec: TableSpec) -> dict[str, list]:
    out = {}
    for layer in ("clean", "quarantine"):
        rows = read_layer(spark, spec, layer).select("order_id", "customer_id", "quantity", "_batch_id", *(["_failed_rules"] if layer == "quarantine" else []))
        out[layer] = sorted(map(repr, rows.collect()))
    return out


@pytest.fixture(scope="module")
def expected(spark, tmp_path_factory):
    spec = _lake(spark, str(tmp_path_factory.mktemp("whole")))
    got = T.reprocess_quarantine(spark, spec, ORDERS_SCHEMA, RELAXED, "again")
    assert [r["order_id"] for r in got.collect()] == ["ORD043"]
    return _layers(spark, spec)


@pytest.mark.parametrize("step, after", [("write_partitioned", True), ("rewrite_partitions", True), ("log_success", False), ("delete", True)])
def test_retry_after_a_break(spark, tmp_dir, monkeypatch, expected, step, after):
    spec = _lake(spark, tmp_dir + "/lake")
    real = getattr(T, step)
    calls = []

    def broken(*args, **kwargs):
        calls.append(step)
        if step == "delete" and len(calls) == 1:
            return real(*args, **kwargs)  # the clearing before the verdicts; the last one breaks
        if after:
            real(*args, **kwargs)
        raise OSError("executor lost")

    monkeypatch.setattr(T, step, broken)
    with pytest.raises(OSError):
        T.reprocess_quarantine(spark, spec, ORDERS_SCHEMA, RELAXED, "again")
    monkeypatch.setattr(T, step, real)
    if step not in ("delete",):
        with pytest.raises(RuntimeError, match="unfinished"):
            T.reprocess_quarantine(spark, spec, ORDERS_SCHEMA, RELAXED, "another")
    for _ in range(2):  # and once more: committed, nothing changes
        got = T.reprocess_quarantine(spark, spec, ORDERS_SCHEMA, RELAXED, "again")
        assert [r["order_id"] for r in got.collect()] == ["ORD043"]
        assert _layers(spark, spec) == expected


def test_rows_that_came_in_meanwhile_stay(spark, tmp_dir, monkeypatch):
    spec = _lake(spark, tmp_dir + "/lake")
    before = read_layer(spark, spec, "quarantine").count()

    def broken(*args, **kwargs):
        raise OSError("executor lost")

    with monkeypatch.context() as m:
        m.setattr(T, "rewrite_partitions", broken)
        with pytest.raises(OSError):
            T.reprocess_quarantine(spark, spec, ORDERS_SCHEMA, RELAXED, "again")
    run_batch(spark, read_raw(spark, spec.root + "/in/c.csv"), spec, orders_rules(), "r2")
    late = read_layer(spark, spec, "quarantine").where("_batch_id = 'r2'").count()
    T.reprocess_quarantine(spark, spec, ORDERS_SCHEMA, RELAXED, "again")
    q = read_layer(spark, spec, "quarantine")
    assert late > 0 and q.where("_batch_id = 'r2'").count() == late
    assert q.where("_batch_id = 'r1'").count() == before - 1
    # the other batch's copy of the promoted order is judged by the next reprocessing: its key is clean by now
    assert T.reprocess_quarantine(spark, spec, ORDERS_SCHEMA, RELAXED, "later").isEmpty()
    reasons = read_layer(spark, spec, "quarantine").where("_batch_id = 'r2' AND order_id = 'ORD043'").first()["_failed_rules"]
    assert reasons == ["order_id_exists_in_clean"]


def test_uncommitted_rows_are_left_alone_and_others_keep_all_columns(spark, tmp_dir):
    spec = _lake(spark, tmp_dir + "/lake")
    was = spark.read.parquet(spec.quarantine_path)
    total = was.count() + read_layer(spark, spec).count()
    stray = was.where("order_id = 'ORD043'").withColumns({"_batch_id": F.lit("half"), "note": F.lit("kept")})
    stray.write.mode("append").partitionBy("year", "month", "day").parquet(spec.quarantine_path)
    times = {r["order_id"]: r["quarantine_timestamp"] for r in was.where("_batch_id = 'r1'").collect()}
    quarantined = was.where("_batch_id = 'r1'").count()
    T.reprocess_quarantine(spark, spec, ORDERS_SCHEMA, RELAXED, "again")
    now = spark.read.option("mergeSchema", "true").parquet(spec.quarantine_path)
    assert [r["note"] for r in now.where("_batch_id = 'half'").collect()] == ["kept"]
    assert all(r["quarantine_timestamp"] == times[r["order_id"]] for r in now.collect())
    # the summary keeps in step with the layers (the half-written row counts nowhere)
    summary = run_summary(spark, spec).first()
    assert summary["valid_records"] == read_layer(spark, spec).count()
    assert summary["invalid_records"] == quarantined - 1 == now.count() - 1
    assert summary["total_records"] == total


def test_nothing_quarantined(spark, tmp_dir):
    spec = TableSpec("orders", tmp_dir + "/lake", ORDERS_SCHEMA)
    assert T.reprocess_quarantine(spark, spec, ORDERS_SCHEMA, RELAXED, "again").isEmpty()
