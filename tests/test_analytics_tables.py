"""Q1-Q21 details, S14-S22 table management, S5 streaming ingest."""

from __future__ import annotations

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from driftgate.operators.rules import orders_rules
from driftgate.plans import analytics as A
from driftgate.plans import tables as T
from driftgate.plans.orders import ORDERS_SCHEMA
from driftgate.plans.pipeline import read_layer, run_batch
from driftgate.settings import TableSpec
from driftgate.sources.files import read_raw
from driftgate.streaming.ingest import IngestConfig, ingest_outcomes, start_file_ingest

from tests.conftest import SF001
from tests.fixtures import HEADER, baseline_rows, invalid_rows, write_csv


def test_affinity_blocks_equal_brute_force(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(1500):
        cust = "big" if i % 3 == 0 else f"c{rnd.randint(0, 40)}"  # one customer holds a third of the rows
        rows.append((cust, f"p{rnd.randint(0, 30):02d}"))
    df = spark.createDataFrame(rows, "customer_id string, product_name string")
    a, b = df.alias("a"), df.alias("b")
    pairs = (
        a.join(b, (F.col("a.customer_id") == F.col("b.customer_id")) & (F.col("a.product_name") < F.col("b.product_name")))
        .groupBy(F.col("a.product_name").alias("product_a"), F.col("b.product_name").alias("product_b"))
        .agg(F.count(F.lit(1)).alias("co_occurrence_count"))
        .filter("co_occurrence_count >= 2")
    )
    brute = pairs.orderBy(F.desc("co_occurrence_count"), "product_a", "product_b").limit(20)
    expected = [tuple(r) for r in brute.collect()]
    for block_size in (2, 5, 256):  # 2 and 5 force many blocks for the big customer
        got = [tuple(r) for r in A.product_affinity(df, block_size=block_size).collect()]
        assert got == expected, block_size
    # and the full pair table, not only the top 20
    full = {tuple(r) for r in A.product_affinity(df, k=10_000, block_size=3).collect()}
    every = {tuple(r) for r in pairs.collect()}
    assert full == every and len(full) > 100


def test_date_range_prunes_partitions(spark, tmp_dir):
    clean = spark.read.parquet(f"{SF001}/orders.parquet").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
    ).withColumns({"year": F.year("order_date"), "month": F.month("order_date"), "day": F.dayofmonth("order_date")})
    path = tmp_dir + "/clean"
    clean.write.partitionBy("year", "month", "day").parquet(path)
    table = spark.read.parquet(path)
    q = A.since(table, dt.date(2001, 7, 2))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "year" in plan.split("PartitionFilters")[1][:300]
    assert q.count() == clean.filter(F.col("order_date") >= dt.date(2001, 7, 2)).count()


def test_growth_rounding_symmetric(spark):
    df = spark.createDataFrame([(1.005,), (-1.005,), (2.5,)], "x double")
    from driftgate.functions.rounding import half_up_ratio, half_up_signed

    vals = [r[0] for r in df.select(half_up_signed(F.col("x") * 100, 0)).collect()]
    assert vals[0] == -vals[1]
    r = spark.range(1).select(half_up_ratio(F.lit(1), F.lit(8)).alias("a"), half_up_ratio(F.lit(5), F.lit(0)).alias("b")).first()
    assert r["a"] == 0.13 and r["b"] is None  # 0.125 rounds half-up; no denominator -> NULL


def test_tables_ddl_partitions_view(spark, tmp_dir):
    spec = TableSpec("orders", tmp_dir + "/lake", ORDERS_SCHEMA)
    run_batch(spark, read_raw(spark, write_csv(tmp_dir + "/in", "a.csv", HEADER, baseline_rows())), spec, orders_rules(), "t1")
    run_batch(spark, read_raw(spark, write_csv(tmp_dir + "/in2", "c.csv", HEADER, invalid_rows())), spec, orders_rules(), "t2")
    db = "lake_t"
    spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    clean, quarantine = T.create_tables(spark, spec, ORDERS_SCHEMA, db)
    T.discover_partitions(spark, clean)
    T.discover_partitions(spark, quarantine)
    assert spark.table(clean).count() == 34
    assert spark.table(quarantine).count() == 6
    parts = spark.sql(f"SHOW PARTITIONS {clean}").count()
    T.drop_partition(spark, clean, 2024, 1, 2)
    assert spark.sql(f"SHOW PARTITIONS {clean}").count() == parts - 1
    T.add_partition(spark, clean, 2024, 1, 2, f"{spec.clean_path}/year=2024/month=1/day=2")
    assert spark.sql(f"SHOW PARTITIONS {clean}").count() == parts
    d = T.describe(spark, clean)
    assert "order_id" in [r["col_name"] for r in d["describe"].collect()]
    assert d["columns"].count() >= len(ORDERS_SCHEMA.fields)
    T.create_summary_view(spark, clean, f"{db}.daily_sales_summary")
    via_view = spark.table(f"{db}.daily_sales_summary").orderBy("order_date", "region").collect()
    via_df = A.daily_sales_summary_view(spark.table(clean)).orderBy("order_date", "region").collect()
    assert [tuple(r) for r in via_view] == [tuple(r) for r in via_df]
    # retention: everything is older than a year on 2026-01-01
    assert T.apply_retention(spark, clean, dt.date(2026, 1, 1), 365) == parts
    assert spark.sql(f"SHOW PARTITIONS {clean}").count() == 0


def test_curated_and_reprocess(spark, tmp_dir):
    spec = TableSpec("orders", tmp_dir + "/lake", ORDERS_SCHEMA)
    run_batch(spark, read_raw(spark, write_csv(tmp_dir + "/in", "c.csv", HEADER, invalid_rows())), spec, orders_rules(), "r1")
    # a fixed rule set: allow quantity 0 now -> that row can be promoted
    relaxed = orders_rules()
    relaxed = type(relaxed)(tuple(r for r in relaxed if r.name != "quantity_positive"))
    promoted = T.reprocess_quarantine(spark, spec, ORDERS_SCHEMA, relaxed, "reprocess-1")
    assert sorted(r["order_id"] for r in promoted.collect()) == ["ORD043"]
    assert read_layer(spark, spec, "clean").count() == 5
    q = read_layer(spark, spec, "quarantine")
    assert q.count() == 5 and q.filter("order_id = 'ORD043'").count() == 0
    # the repeated id stays quarantined: its key is already clean
    assert q.filter("order_id = 'ORD041'").count() == 1
    T.materialize(A.daily_sales_summary_view(read_layer(spark, spec, "clean")).withColumns(
        {"year": F.year("order_date"), "month": F.month("order_date"), "day": F.dayofmonth("order_date")}), spec.curated_path)
    assert spark.read.parquet(spec.curated_path).count() > 0


def test_stream_equals_batch_and_restart(spark, tmp_dir):
    spec = TableSpec("orders", tmp_dir + "/lake", ORDERS_SCHEMA)
    raw = spec.raw_path
    write_csv(raw, "a.csv", HEADER, baseline_rows())
    write_csv(raw, "c.csv", HEADER, invalid_rows())
    write_csv(raw, "_tmp.csv", HEADER, baseline_rows(3, start=500))  # hidden: never read
    write_csv(raw, "e.csv", HEADER, [])  # empty file: empty batch
    q = start_file_ingest(spark, spec, orders_rules(), config=IngestConfig(query_name="t_ingest"))
    q.awaitTermination(300)
    clean = read_layer(spark, spec, "clean")
    assert clean.count() == 34
    assert read_layer(spark, spec, "quarantine").count() == 6
    # batch result of the same files is the same
    batch_spec = TableSpec("orders", tmp_dir + "/batchlake", ORDERS_SCHEMA)
    for i, name in enumerate(["a.csv", "c.csv"]):
        run_batch(spark, read_raw(spark, os.path.join(raw, name)), batch_spec, orders_rules(), f"b{i}")
    cols = [f.name for f in ORDERS_SCHEMA.fields]
    assert sorted(map(tuple, clean.select(cols).collect()), key=str) == sorted(
        map(tuple, read_layer(spark, batch_spec, "clean").select(cols).collect()), key=str
    )
    # a restart on the same checkpoint replays nothing
    q2 = start_file_ingest(spark, spec, orders_rules(), config=IngestConfig(query_name="t_ingest"))
    q2.awaitTermination(300)
    assert read_layer(spark, spec, "clean").count() == 34
    assert ingest_outcomes(spark, spec).first()["succeeded"] == 2


def test_stream_takes_every_format_and_outlives_a_bad_file(spark, tmp_dir):
    spec = TableSpec("orders", tmp_dir + "/lake", ORDERS_SCHEMA)
    a = write_csv(spec.raw_path, "A.CSV", HEADER, baseline_rows(4, start=10))
    read_raw(spark, a).write.parquet(f"{tmp_dir}/p")
    part = next(f for f in os.listdir(f"{tmp_dir}/p") if f.endswith(".parquet"))
    os.link(f"{tmp_dir}/p/{part}", f"{spec.raw_path}/c.parquet")
    with open(f"{spec.raw_path}/b.parquet", "w") as f:
        f.write("no parquet file")
    with open(f"{spec.raw_path}/d.json", "w") as f:
        f.write('{"order_id": "J1", "customer_id": "C", "quantity": 1, "price": 2.5, "order_date": "2024-01-05"}\n')
    start_file_ingest(spark, spec, orders_rules(), config=IngestConfig(query_name="t_formats")).awaitTermination(300)
    # one failed, three succeeded; UNIQUE is per file, so the copy of A.CSV is clean too
    assert tuple(ingest_outcomes(spark, spec).select("succeeded", "failed").first()) == (3, 1)
    assert read_layer(spark, spec, "clean").count() == 9


def test_stream_reads_each_file_by_its_header(spark, tmp_dir):
    """A drifted file (new column, reordered columns) is read by name, not position."""
    from tests.fixtures import new_column_rows

    spec = TableSpec("orders", tmp_dir + "/lake", ORDERS_SCHEMA)
    header, rows = new_column_rows()
    write_csv(spec.raw_path, "b.csv", header, rows)
    # same rows with the columns in another order
    cols = HEADER.split(",")
    order = [cols[i] for i in (7, 6, 5, 4, 3, 2, 1, 0)]
    reordered = [",".join(dict(zip(cols, r.split(",")))[c] for c in order) for r in baseline_rows(5, start=700)]
    write_csv(spec.raw_path, "d.csv", ",".join(order), reordered)
    q = start_file_ingest(spark, spec, orders_rules(), config=IngestConfig(query_name="t_ingest2"))
    q.awaitTermination(300)
    clean = read_layer(spark, spec, "clean")
    assert clean.count() == 15
    assert clean.filter("shipping_method IS NOT NULL").count() == 10
    assert clean.filter("order_id = 'ORD700'").select("region").first()[0] in ("US-EAST", "US-WEST", "EU-WEST", "ASIA-PACIFIC")


def test_money_averages_against_plain_average(spark):
    """avg_order_value / avg_lifetime_value equal round(avg(...), 2) computed the plain way."""
    from decimal import ROUND_HALF_UP, Decimal

    rows = [("c1", "completed", Decimal("10.01"), 3, "EU"), ("c1", "completed", Decimal("0.02"), 1, "EU"),
            ("c2", "completed", Decimal("99.99"), 2, "EU"), ("c3", "pending", Decimal("5.00"), 1, "US")]
    df = spark.createDataFrame(rows, "customer_id string, status string, price decimal(10,2), quantity int, region string") \
        .withColumn("order_id", F.col("customer_id")).withColumn("order_date", F.lit(dt.date(2001, 1, 1)))
    got = A.revenue_by_region(df).first()
    vals = [Decimal("10.01") * 3, Decimal("0.02"), Decimal("99.99") * 2]
    expect = (sum(vals) / len(vals)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
    assert got["avg_order_value"] == float(expect)
    seg = {r["customer_segment"]: r for r in A.customer_segments(df, dt.date(2001, 8, 1)).collect()}
    per_customer = [Decimal("10.01") * 3 + Decimal("0.02"), Decimal("99.99") * 2]
    assert seg["Regular"]["avg_lifetime_value"] == float(per_customer[0])
    assert seg["New"]["avg_lifetime_value"] == float(per_customer[1])


def test_catalog_table_is_the_registry(spark, tmp_dir):
    """With a catalog table, drift is measured against it and new columns are added to it."""
    from pyspark.sql.types import StructType

    from tests.fixtures import new_column_rows

    typed = StructType([f for f in ORDERS_SCHEMA.fields if f.name != "shipping_method"])
    spec = TableSpec("orders", tmp_dir + "/lake", None, catalog_table="cat_orders")
    spark.sql("DROP TABLE IF EXISTS cat_orders")
    spark.sql(T.create_table_sql("cat_orders", typed, spec.clean_path, "`_batch_id` string"))
    header, rows = new_column_rows()
    out = run_batch(spark, read_raw(spark, write_csv(tmp_dir + "/in", "b.csv", header, rows)), spec, orders_rules(), "c1")
    assert ("new_column", "shipping_method") in [(c.change_type, c.column_name) for c in out.comparison.changes]
    cols = [c.name for c in spark.catalog.listColumns("cat_orders")]
    assert "shipping_method" in cols
    T.discover_partitions(spark, "cat_orders")
    assert spark.table("cat_orders").filter("shipping_method IS NOT NULL").count() == 10


def test_hot_day_is_written_by_several_tasks(spark, tmp_dir):
    """A day holding a third of the rows is cut into several files; small days stay one file each."""
    import glob

    from driftgate.sinks.writers import write_partitioned

    n = 30_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(dt.date(2024, 1, 1)))
        .otherwise(F.date_add(F.lit(dt.date(2024, 2, 1)), (F.col("id") % 200).cast("int")))
        .alias("order_date"),
        F.col("id").cast("string").alias("order_id"),
    ).withColumns({"year": F.year("order_date"), "month": F.month("order_date"), "day": F.dayofmonth("order_date")})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_partitioned(df, tmp_dir + "/w")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    hot = glob.glob(tmp_dir + "/w/year=2024/month=1/day=1/*.parquet")
    assert len(hot) > 1
    small = [len(glob.glob(p + "/*.parquet")) for p in glob.glob(tmp_dir + "/w/year=2024/month=3/day=*")]
    assert small and max(small) <= 2
    assert spark.read.parquet(tmp_dir + "/w").count() == n


def test_write_of_a_few_days(spark, tmp_dir):
    """A batch of one day goes through the one write plan."""
    from driftgate.sinks.writers import write_partitioned

    df = spark.range(5000).select(
        F.lit(dt.date(2024, 5, 1)).alias("order_date"), F.col("id").cast("string").alias("order_id")
    ).withColumns({"year": F.lit(2024), "month": F.lit(5), "day": F.lit(1)})
    write_partitioned(df, tmp_dir + "/d")
    back = spark.read.parquet(tmp_dir + "/d")
    assert back.count() == 5000 and back.select("day").distinct().count() == 1


def test_approximate_distinct_option(spark):
    clean = _clean_sf001(spark)
    exact = {r["region"]: r for r in A.revenue_by_region(clean).collect()}
    approx = {r["region"]: r for r in A.revenue_by_region(clean, approx_distinct=True).collect()}
    assert exact.keys() == approx.keys()
    for k in exact:
        assert abs(approx[k]["total_orders"] - exact[k]["total_orders"]) <= 0.1 * exact[k]["total_orders"]
        assert approx[k]["total_revenue"] == exact[k]["total_revenue"]  # sums stay exact


def _clean_sf001(spark):
    from driftgate.sources.driver_tables import clean_orders

    return clean_orders(spark, SF001)


def _affinity_rows(spark):
    """40 products bought together often, 2,000 products bought once each, one customer with a third of the rows, NULLs."""
    rnd = random.Random(11)
    rows = [(f"c{i % 200}", f"hot{rnd.randint(0, 39):02d}") for i in range(8000)]
    rows += [("big", f"rare{i % 2000:04d}") for i in range(4000)]
    rows += [(None, "hot00"), ("c1", None), (None, None)] * 3
    return spark.createDataFrame(rows, "customer_id string, product_name string")


def _affinity_brute(df, k):
    a, b = df.alias("a"), df.alias("b")
    same = (F.col("a.customer_id") == F.col("b.customer_id")) & (F.col("a.product_name") < F.col("b.product_name"))
    pairs = a.join(b, same).groupBy(F.col("a.product_name").alias("pa"), F.col("b.product_name").alias("pb")).agg(F.count(F.lit(1)).alias("c"))
    return [tuple(r) for r in pairs.where("c >= 2").orderBy(F.desc("c"), "pa", "pb").limit(k).collect()]


def test_affinity_pruning_keeps_the_report(spark):
    df = _affinity_rows(spark).repartition(8).cache()
    for k, seeds in ((20, 64), (20, 7), (20, 2), (5, 64), (780, 64)):
        # 2 and 7 seeds give few pairs or a low floor: less is pruned, the rows are the same
        got = [tuple(r) for r in A.product_affinity(df, k=k, seeds=seeds, block_size=16).collect()]
        assert got == _affinity_brute(df, k), (k, seeds)


def test_affinity_prunes_products_before_pairing(spark):
    df = _affinity_rows(spark).where("customer_id IS NOT NULL AND product_name IS NOT NULL")
    cp = df.groupBy("customer_id", "product_name").agg(F.count(F.lit(1)).alias("n"))
    mass = A.product_mass(cp)
    floor = A.affinity_floor(cp, mass, 20, 2, 64)
    kth = _affinity_brute(df, 20)[-1][2]
    assert spark.range(1).select(floor).first()[0] == kth  # the heaviest products hold the report here
    left = mass.where(A.reaches(F.col("mass"), mass.agg(F.max("mass")).scalar(), floor))
    assert left.where("product_name LIKE 'rare%'").isEmpty() and left.count() == 40


def test_affinity_ties_nulls_and_empty(spark):
    every = [("c1", p) for p in "abcdefgh"] * 2  # each of 28 pairs counts 4
    df = spark.createDataFrame(every, "customer_id string, product_name string")
    assert [tuple(r) for r in A.product_affinity(df, seeds=3, block_size=2).collect()] == _affinity_brute(df, 20)
    assert A.product_affinity(df.limit(0)).isEmpty()
    assert A.product_affinity(df.selectExpr("CAST(NULL AS string) AS customer_id", "product_name")).isEmpty()


def test_affinity_has_no_window(spark):
    plan = A.product_affinity(_affinity_rows(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
