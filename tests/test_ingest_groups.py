"""Files by header group, errors that pass, keys across batches, retention by partition and file times."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from driftgate.operators.rules import orders_rules
from driftgate.operators.uniqueness import held_keys, key_filter, with_held
from driftgate.plans import tables as T
from driftgate.plans.orders import ORDERS_SCHEMA
from driftgate.plans.pipeline import read_layer, read_run_log, run_batch
from driftgate.settings import TableSpec
from driftgate.streaming import ingest
from driftgate.streaming.ingest import IngestConfig, by_header, ingest_outcomes, start_file_ingest
from tests.fixtures import HEADER, baseline_rows, write_csv


def test_one_plan_per_header(spark, tmp_dir):
    spec = TableSpec("orders", tmp_dir + "/lake", ORDERS_SCHEMA)
    cols = HEADER.split(",")
    for i in range(12):
        rows = baseline_rows(3, start=100 * (i + 1))
        if i % 3 == 1:
            rows = [",".join(reversed(r.split(","))) for r in rows]
        header = HEADER if i % 3 != 1 else ",".join(reversed(cols))
        write_csv(spec.raw_path, f"f {i:02d}.csv", header if i % 3 != 2 else header + ",note", rows if i % 3 != 2 else [r + ",x" for r in rows])
    paths = sorted(f"file:{spec.raw_path}/{f}" for f in os.listdir(spec.raw_path))
    assert sorted(map(len, by_header(spark, paths))) == [4, 4, 4]
    start_file_ingest(spark, spec, orders_rules(), config=IngestConfig(query_name="t_groups", max_files_per_trigger=100)).awaitTermination(300)
    assert read_run_log(spark, spec).count() == 3 and ingest_outcomes(spark, spec).first()["succeeded"] == 3
    clean = read_layer(spark, spec)
    assert clean.count() == 36 and clean.select("order_id").distinct().count() == 36 and clean.where("note = 'x'").count() == 12


def test_a_passing_error_is_tried_again(spark, tmp_dir, monkeypatch):
    spec = TableSpec("orders", tmp_dir + "/lake", ORDERS_SCHEMA)
    write_csv(spec.raw_path, "a.csv", HEADER, baseline_rows(4))
    real = ingest.run_batch

    def down(*args, **kwargs):
        raise OSError("the store does not answer")

    monkeypatch.setattr(ingest, "run_batch", down)
    config = IngestConfig(query_name="t_passing")
    with pytest.raises(Exception, match="does not answer"):
        start_file_ingest(spark, spec, orders_rules(), config=config).awaitTermination(300)
    monkeypatch.setattr(ingest, "run_batch", real)
    start_file_ingest(spark, spec, orders_rules(), config=config).awaitTermination(300)
    assert tuple(ingest_outcomes(spark, spec).select("succeeded", "failed").first()) == (1, 0) and read_layer(spark, spec).count() == 4


def test_keys_across_batches(spark, tmp_dir):
    spec = TableSpec("orders", tmp_dir + "/lake", ORDERS_SCHEMA)
    from driftgate.sources.files import read_raw

    first = read_raw(spark, write_csv(tmp_dir, "a.csv", HEADER, baseline_rows(5, start=1)))
    second = read_raw(spark, write_csv(tmp_dir, "b.csv", HEADER, baseline_rows(5, start=4)))
    run_batch(spark, first, spec, orders_rules(), "one", unique_in_table="order_id")
    out = run_batch(spark, second, spec, orders_rules(), "two", unique_in_table="order_id")
    assert (out.metrics["valid_records"], out.metrics["invalid_records"]) == (3, 2)
    assert read_layer(spark, spec).groupBy("order_id").count().where("count > 1").isEmpty()
    reasons = {tuple(r[0]) for r in read_layer(spark, spec, "quarantine").select("_failed_rules").collect()}
    assert reasons == {("order_id_exists_in_clean",)}


@pytest.mark.parametrize("bits", [1 << 12, 1 << 20])
def test_the_filter_loses_no_key_and_spares_the_shuffle(spark, bits):
    """A filter far too small for its keys is full, and the result is the same."""
    table = spark.range(0, 40_000, 2).withColumnRenamed("id", "k")
    batch = spark.createDataFrame([(i,) for i in [*range(100, 3000), None, 100]], "k long")
    assert {r.k for r in held_keys(batch, table, "k", bits).collect()} == set(range(100, 3000, 2))
    flagged = with_held(batch, table, "k", "held", bits)
    assert flagged.count() == 2902 and flagged.where("held").count() == 1451 and flagged.where("k is null").first().held is False
    assert key_filter(batch, "k", bits).count() <= bits // 4096
    plan = held_keys(batch, table, "k", bits)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 2 and "bit_get" in plan


def test_retention_by_partition_and_file_times(spark, tmp_dir):
    rows = [("a", 2024, 1, 1), ("late", 2024, 1, 2), ("new", 2026, 5, 1), ("none", None, None, None)]
    path, db = f"{tmp_dir}/clean", "lake_retention"
    spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    spark.sql(f"CREATE DATABASE {db}")
    df = spark.createDataFrame(rows, "order_id string, year int, month int, day int")
    df.write.partitionBy("year", "month", "day").parquet(path)
    spark.sql(T.create_table_sql(f"{db}.t", df.select("order_id").schema, path))
    T.discover_partitions(spark, f"{db}.t")
    old, lately = dt.datetime(2024, 2, 1).timestamp(), dt.datetime(2026, 4, 1).timestamp()
    for folder, _, files in os.walk(path):
        for f in files:
            os.utime(os.path.join(folder, f), (lately if "day=2" in folder else old,) * 2)
    gone = T.expired_partitions(spark, path, dt.date(2026, 6, 1), 365)
    assert "content" not in gone._jdf.queryExecution().optimizedPlan().toString().split("Relation")[0]
    assert T.apply_retention(spark, f"{db}.t", dt.date(2026, 6, 1), 365) == 2
    assert {r.order_id for r in spark.read.parquet(path).collect()} == {"late", "new"}
    assert spark.sql(f"SHOW PARTITIONS {db}.t").count() == 2
    # once the late file is old enough, it goes as well
    assert T.apply_retention(spark, f"{db}.t", dt.date(2027, 4, 15), 365) == 1
    assert spark.read.parquet(path).select(F.count("*")).first()[0] == 1
