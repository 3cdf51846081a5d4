"""The four documented scenarios, end to end through run_batch (FIXTURES §1)."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from driftgate.operators.rules import orders_rules
from driftgate.operators.registry import SchemaRegistry
from driftgate.operators.schema_diff import DATATYPE_CHANGE, NEW_COLUMN
from driftgate.plans.orders import ORDERS_SCHEMA
from driftgate.plans.pipeline import read_layer, run_batch, run_summary
from driftgate.settings import TableSpec
from driftgate.sources.files import read_raw
from driftgate.streaming.ingest import ingest_outcomes
from pyspark.sql.types import StructType

from tests.fixtures import HEADER, baseline_rows, invalid_rows, new_column_rows, write_csv

TYPED = StructType([f for f in ORDERS_SCHEMA.fields if f.name != "shipping_method"])


def _spec(root, registered=TYPED):
    return TableSpec(name="orders", root=root, registered_schema=registered)


def test_baseline_untyped(spark, tmp_dir):
    path = write_csv(tmp_dir + "/in", "a.csv", HEADER, baseline_rows())
    out = run_batch(spark, read_raw(spark, path), _spec(tmp_dir + "/lake", None), orders_rules(), "b1")
    assert out.metrics["total_records"] == 30
    assert out.metrics["valid_records"] == 30
    assert out.metrics["invalid_records"] == 0
    assert out.metrics["data_quality_score"] == 100.0
    assert out.alerts == []
    assert out.comparison.is_new_table
    # a new table registers version 1
    assert SchemaRegistry(spark, _spec(tmp_dir + "/lake").registry_path).latest("orders")[0] == 1


def test_new_column_against_typed(spark, tmp_dir):
    header, rows = new_column_rows()
    path = write_csv(tmp_dir + "/in", "b.csv", header, rows)
    out = run_batch(spark, read_raw(spark, path), _spec(tmp_dir + "/lake"), orders_rules(), "b2")
    kinds = sorted((c.change_type, c.column_name) for c in out.comparison.changes)
    assert (NEW_COLUMN, "shipping_method") in kinds
    assert (DATATYPE_CHANGE, "price") in kinds  # inferred double vs registered decimal(10,2)
    assert out.metrics["valid_records"] == 10
    assert out.metrics["data_quality_score"] == 100.0
    assert out.alerts == []
    clean = spark.read.parquet(_spec(tmp_dir + "/lake").clean_path)
    assert "shipping_method" in clean.columns
    assert clean.schema["price"].dataType.simpleString() == "decimal(10,2)"


def test_invalid_data_typed(spark, tmp_dir):
    path = write_csv(tmp_dir + "/in", "c.csv", HEADER, invalid_rows())
    spec = _spec(tmp_dir + "/lake")
    out = run_batch(spark, read_raw(spark, path), spec, orders_rules(), "b3")
    assert (out.metrics["valid_records"], out.metrics["invalid_records"]) == (4, 6)
    assert out.metrics["data_quality_score"] == 75.25
    kinds = sorted(a["alert_type"] for a in out.alerts)
    assert kinds == ["INVALID_RECORDS_THRESHOLD_EXCEEDED", "LOW_QUALITY_SCORE"]
    q = spark.read.parquet(spec.quarantine_path)
    assert q.count() == 6
    # the quarantine keeps the original text of the date it could not type
    assert q.filter(F.col("order_date") == "invalid-date").count() == 1
    assert q.filter(F.col("order_date") == "invalid-date").select("year").first()[0] is None
    # the repeated id: the first occurrence stays valid, the second fails UNIQUE only
    rep = q.filter(F.col("order_id") == "ORD041").select("_failed_rules").first()[0]
    assert rep == ["order_id_unique"]


def test_invalid_data_untyped(spark, tmp_dir):
    path = write_csv(tmp_dir + "/in", "c.csv", HEADER, invalid_rows())
    out = run_batch(spark, read_raw(spark, path), _spec(tmp_dir + "/lake", None), orders_rules(), "b3")
    assert (out.metrics["valid_records"], out.metrics["invalid_records"]) == (5, 5)
    assert out.metrics["data_quality_score"] == 79.25


def test_all_three_in_sequence(spark, tmp_dir):
    spec = _spec(tmp_dir + "/lake")
    a = write_csv(tmp_dir + "/in1", "a.csv", HEADER, baseline_rows())
    header, rows = new_column_rows()
    b = write_csv(tmp_dir + "/in2", "b.csv", header, rows)
    c = write_csv(tmp_dir + "/in3", "c.csv", HEADER, invalid_rows())
    for i, p in enumerate([a, b, c]):
        run_batch(spark, read_raw(spark, p), spec, orders_rules(), f"seq-{i}")
    clean = read_layer(spark, spec, "clean")
    assert clean.count() == 44
    assert spark.read.parquet(spec.quarantine_path).count() == 6
    # the registry evolved once: shipping_method is part of version 2
    version, schema = SchemaRegistry(spark, spec.registry_path).latest("orders")
    assert version == 2 and "shipping_method" in schema.fieldNames()
    # the third file lacks shipping_method: its clean rows carry NULL there
    assert clean.filter(F.col("order_id") == "ORD041").select("shipping_method").first()[0] is None
    summary = run_summary(spark, spec).first()
    assert (summary["succeeded"], summary["failed"], summary["valid_records"]) == (3, 0, 44)
    assert ingest_outcomes(spark, spec).first()["succeeded"] == 3


def test_rerun_same_batch_is_noop(spark, tmp_dir):
    spec = _spec(tmp_dir + "/lake")
    a = write_csv(tmp_dir + "/in", "a.csv", HEADER, baseline_rows())
    run_batch(spark, read_raw(spark, a), spec, orders_rules(), "once")
    again = run_batch(spark, read_raw(spark, a), spec, orders_rules(), "once")
    assert again.skipped
    assert spark.read.parquet(spec.clean_path).count() == 30


def test_half_written_batch_is_replaced(spark, tmp_dir):
    """A batch that wrote clean rows but crashed before its run-log row is redone, not doubled."""
    from driftgate.sinks.writers import BATCH_ID, with_partitions, write_partitioned

    spec = _spec(tmp_dir + "/lake")
    a = write_csv(tmp_dir + "/in", "a.csv", HEADER, baseline_rows())
    b = write_csv(tmp_dir + "/in2", "b.csv", HEADER, baseline_rows(5, start=100))
    run_batch(spark, read_raw(spark, b), spec, orders_rules(), "other")
    # simulate the crash: "crashy" is started, its rows land in clean, no run-log row
    from driftgate.operators.evolve import conform
    from driftgate.plans.pipeline import mark_started

    assert not mark_started(spark, spec, "crashy")

    partial = with_partitions(conform(read_raw(spark, a), TYPED).withColumn(BATCH_ID, F.lit("crashy")))
    write_partitioned(partial, spec.clean_path)
    assert spark.read.parquet(spec.clean_path).count() == 35
    run_batch(spark, read_raw(spark, a), spec, orders_rules(), "crashy")
    clean = spark.read.parquet(spec.clean_path)
    assert clean.count() == 35
    assert clean.filter(F.col(BATCH_ID) == "other").count() == 5


def test_first_attempt_reads_no_layer_and_unreadable_logs_raise(spark, tmp_dir, monkeypatch):
    import pytest

    from driftgate.plans import pipeline

    spec = _spec(tmp_dir + "/lake")
    a = write_csv(tmp_dir + "/in", "a.csv", HEADER, baseline_rows())
    seen = []
    monkeypatch.setattr(pipeline, "remove_batch", lambda *args: seen.append(args))
    run_batch(spark, read_raw(spark, a), spec, orders_rules(), "first")
    assert not seen
    log = spec.run_log_path
    for folder, _, files in os.walk(log):
        for f in files:
            if f.endswith(".parquet"):
                with open(os.path.join(folder, f), "w") as out:
                    out.write("not parquet")
    with pytest.raises(Exception):
        run_batch(spark, read_raw(spark, a), spec, orders_rules(), "first")


def test_empty_batch_guard(spark, tmp_dir):
    path = write_csv(tmp_dir + "/in", "e.csv", HEADER, [])
    out = run_batch(spark, read_raw(spark, path), _spec(tmp_dir + "/lake"), orders_rules(), "empty")
    assert out.empty
    assert not os.path.exists(_spec(tmp_dir + "/lake").clean_path)


def test_recovery_keeps_columns_added_later(spark, tmp_dir):
    """Rewriting partitions during recovery must not drop a column newer files have."""
    from driftgate.sinks.writers import BATCH_ID, remove_batch

    spec = _spec(tmp_dir + "/lake")
    a = write_csv(tmp_dir + "/in1", "a.csv", HEADER, baseline_rows(5))
    header, rows = new_column_rows()
    # same days as file a, with shipping_method
    rows = [r.replace("ORD0", "NEW0") for r in rows]
    b = write_csv(tmp_dir + "/in2", "b.csv", header, rows)
    run_batch(spark, read_raw(spark, a), spec, orders_rules(), "old")
    run_batch(spark, read_raw(spark, b), spec, orders_rules(), "new")
    remove_batch(spark, spec.clean_path, "old")
    left = spark.read.option("mergeSchema", "true").parquet(spec.clean_path)
    assert left.filter(F.col(BATCH_ID) == "old").count() == 0
    assert left.filter(F.col("shipping_method").isNotNull()).count() == 10


def test_incompatible_batch_policies(spark, tmp_dir):
    """§2.11-9: a batch missing a registered column is evolved, quarantined whole, or refused."""
    import pytest

    from driftgate.operators.evolve import SchemaDriftError

    dropped = ",".join(c for c in HEADER.split(",") if c != "customer_id")
    rows = [",".join(v for c, v in zip(HEADER.split(","), r.split(",")) if c != "customer_id") for r in baseline_rows(6)]
    path = write_csv(tmp_dir + "/in", "m.csv", dropped, rows)
    spec = _spec(tmp_dir + "/lake")
    with pytest.raises(SchemaDriftError):
        run_batch(spark, read_raw(spark, path), spec, orders_rules(), "p-fail", on_incompatible="fail")
    out = run_batch(spark, read_raw(spark, path), spec, orders_rules(), "p-quar", on_incompatible="quarantine")
    assert (out.metrics["valid_records"], out.metrics["invalid_records"]) == (0, 6)
    q = spark.read.parquet(spec.quarantine_path)
    assert q.filter(F.array_contains("_failed_rules", "schema_incompatible")).count() == 6
    assert run_summary(spark, spec).first()["failed"] == 1  # the refused batch is logged (S6)
    evolved = run_batch(spark, read_raw(spark, path), _spec(tmp_dir + "/lake2"), orders_rules(), "p-evolve")
    # evolve: customer_id added as NULL, so the NOT NULL rule rejects every row
    assert evolved.metrics["invalid_records"] == 6


def test_run_log_buckets_and_compaction(spark, tmp_dir):
    from driftgate.plans.pipeline import read_run_log
    from driftgate.sinks.writers import compact_log

    spec = _spec(tmp_dir + "/lake")
    a = write_csv(tmp_dir + "/in", "a.csv", HEADER, baseline_rows(4))
    for i in range(3):
        run_batch(spark, read_raw(spark, a), spec, orders_rules(), f"k{i}")
    assert read_run_log(spark, spec).count() == 3
    compact_log(spark, spec.run_log_path, partition_by=("bucket",))
    assert read_run_log(spark, spec).count() == 3
    assert run_batch(spark, read_raw(spark, a), spec, orders_rules(), "k1").skipped  # still found after compaction


def test_log_retention_drops_old_rows(spark, tmp_dir):
    import datetime as dt

    from driftgate.sinks.writers import compact_log, write_rows

    path = tmp_dir + "/logs/metrics"
    old = spark.createDataFrame([("t", dt.datetime(2020, 1, 1))], "table_name string, execution_timestamp timestamp")
    new = spark.createDataFrame([("t", dt.datetime(2024, 6, 1))], "table_name string, execution_timestamp timestamp")
    write_rows(old, path, "json")
    write_rows(new, path, "json")
    compact_log(spark, path, fmt="json", keep_since=("execution_timestamp", dt.datetime(2024, 1, 1)))
    left = spark.read.json(path).collect()
    assert len(left) == 1 and left[0]["execution_timestamp"].startswith("2024-06-01")


def test_pipeline_is_generic_events(spark, tmp_dir):
    """Another dataset: events keyed by event_id, partitioned by the day of ts."""
    from driftgate.operators.rules import Rule, RuleSet

    rows = [
        (1, "2024-03-01 10:00:00", "click", 1.5),
        (1, "2024-03-01 10:05:00", "view", 2.0),  # repeated id
        (2, "not-a-time", "click", 3.0),  # bad timestamp
        (3, "2024-03-02 09:00:00", None, -1.0),  # no type, negative value
        (4, "2024-03-02 11:00:00", "view", 0.5),
    ]
    raw = spark.createDataFrame(rows, "event_id bigint, ts string, event_type string, value double")
    registered = StructType.fromJson(
        {"type": "struct", "fields": [
            {"name": "event_id", "type": "long", "nullable": True, "metadata": {}},
            {"name": "ts", "type": "timestamp", "nullable": True, "metadata": {}},
            {"name": "event_type", "type": "string", "nullable": True, "metadata": {}},
            {"name": "value", "type": "double", "nullable": True, "metadata": {}},
        ]}
    )
    spec = TableSpec("events", tmp_dir + "/lake", registered, date_column="ts")
    rules = RuleSet((
        Rule.unique("event_id", order_by=["ts"]),
        Rule.not_null("ts"),
        Rule.not_null("event_type"),
        Rule.range("value", min=0),
    ))
    out = run_batch(spark, raw, spec, rules, "e1")
    assert (out.metrics["valid_records"], out.metrics["invalid_records"]) == (2, 3)
    q = read_layer(spark, spec, "quarantine")
    assert q.filter("ts = 'not-a-time'").count() == 1  # original text kept
    clean = read_layer(spark, spec, "clean")
    assert sorted(r["event_id"] for r in clean.collect()) == [1, 4]
    assert sorted((r["year"], r["month"], r["day"]) for r in clean.collect()) == [(2024, 3, 1), (2024, 3, 2)]


def test_match_mode_drops_new_columns_and_keeps_the_registry(spark, tmp_dir):
    header, rows = new_column_rows()
    path = write_csv(tmp_dir + "/in", "b.csv", header, rows)
    spec = _spec(tmp_dir + "/lake")
    run_batch(spark, read_raw(spark, path), spec, orders_rules(), "m1", mode="match")
    assert "shipping_method" not in spark.read.parquet(spec.clean_path).columns
    assert SchemaRegistry(spark, spec.registry_path).latest("orders") is None  # nothing published
