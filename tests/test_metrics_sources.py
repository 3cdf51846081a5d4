"""M1-M10 metrics and alerts; S3/S4 admission and events; S1/S2 scans."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from driftgate.operators.alerts import check_thresholds, digest
from driftgate.operators.metrics import collect_metrics, duplicate_count, metrics_json, null_counts, numeric_summary
from driftgate.operators.rules import Rule
from driftgate.operators.validate import validate
from driftgate.settings import Thresholds
from driftgate.sources.admission import admitted, parse_events
from driftgate.sources.files import format_of, read_raw

from tests.fixtures import HEADER, baseline_rows, write_csv


def _metrics(spark, rows, schema, rules):
    df = spark.createDataFrame(rows, schema)
    return collect_metrics(df, validate(df, rules), "t")


def test_score_and_counts(spark):
    # 4 rows, 2 columns, 1 whole-row duplicate pair, 1 NULL cell, 1 invalid row
    rows = [("a", 1.0), ("a", 1.0), ("b", None), ("c", 2.0)]
    m = _metrics(spark, rows, "k string, v double", [Rule.not_null("v")]).first()
    assert (m["total_records"], m["valid_records"], m["invalid_records"]) == (4, 3, 1)
    assert m["duplicate_records"] == 1
    assert m["null_counts"] == {"k": 0, "v": 1}
    # 40*3/4 + 30*3/4 + 30*7/8 = 30 + 22.5 + 26.25
    assert m["data_quality_score"] == 78.75
    assert [r["failed_count"] for r in m["validation_results"]] == [1]
    assert m["schema_info"]["column_count"] == 2


def test_nan_counts_only_for_floating(spark):
    df = spark.createDataFrame([(float("nan"), "x"), (1.0, None)], "v double, s string")
    got = {r["column_name"]: r["null_count"] for r in null_counts(df).collect()}
    assert got == {"v": 1, "s": 1}


def test_empty_batch_score_zero(spark):
    m = _metrics(spark, [], "k string", [Rule.not_null("k")]).first()
    assert m["total_records"] == 0 and m["data_quality_score"] == 0.0


def test_duplicates_with_map_column(spark):
    df = spark.createDataFrame([({"a": 1},), ({"a": 1},), ({"b": 2},)], "m map<string,int>")
    assert duplicate_count(df).first()[0] == 1


def test_alerts_strict_thresholds_and_digest(spark):
    rows = [("a", None)] * 3 + [("b", 1.0)] * 7
    m = _metrics(spark, rows, "k string, v double", [Rule.not_null("v")])
    alerts = check_thresholds(m).collect()
    kinds = sorted(a["alert_type"] for a in alerts)
    # 30% invalid > 5; duplicates 8/10 > 2; score below 85
    assert kinds == ["DUPLICATE_RECORDS_THRESHOLD_EXCEEDED", "INVALID_RECORDS_THRESHOLD_EXCEEDED", "LOW_QUALITY_SCORE"]
    inv = next(a for a in alerts if a["alert_type"].startswith("INVALID"))
    assert inv["message"] == "Invalid records percentage (30.00%) exceeds threshold (5.0%)"
    d = digest(check_thresholds(m)).first()
    assert d["subject"] == "Data Quality Alert - 2 Errors, 1 Warnings"
    assert d["body"].count("[ERROR]") == 2
    body = d["body"]  # blocks in check order: invalid share, duplicates, score
    assert body.index("INVALID_RECORDS") < body.index("DUPLICATE_RECORDS") < body.index("LOW_QUALITY_SCORE")
    # thresholds are strict inequalities
    lenient = Thresholds(max_invalid_percentage=30.0, max_duplicate_percentage=80.0, min_quality_score=0.0)
    assert check_thresholds(m, lenient).count() == 0


def test_metrics_json(spark):
    m = _metrics(spark, [("a", 1.0)], "k string, v double", [Rule.not_null("v")])
    doc = json.loads(metrics_json(m).first()[0])
    assert doc["table_name"] == "t" and doc["data_quality_score"] == 100.0


def test_numeric_summary(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 101)], "q int, p double")
    rows = {r["column_name"]: r for r in numeric_summary(df).collect()}
    assert rows["q"]["count"] == 100 and rows["q"]["min"] == 1 and rows["q"]["max"] == 100
    assert rows["q"]["p50"] == 50 and rows["p"]["mean"] == 50.5


def test_admission_cases(spark):
    # (key, size, expected) per the documented admission rules
    cases = [
        ("raw/orders/a.csv", 10, True),
        ("raw/orders/x/B.PARQUET", 10, True),
        ("raw/orders/c.json", 10, True),
        ("clean/orders/a.csv", 10, False),
        ("raw/orders/a.txt", 10, False),
        ("raw/orders/a.csv", 0, False),
        ("raw/orders/_tmp.csv", 10, False),
        ("raw/orders/.a.csv", 10, False),
    ]
    df = spark.createDataFrame(cases, "key string, size bigint, expected boolean")
    out = df.select((admitted(F.col("key"), F.col("size"), "raw/orders/") == F.col("expected")).alias("ok")).collect()
    assert all(r["ok"] for r in out)


def test_parse_events_decodes_and_filters(spark):
    def ev(key, size, source="aws:s3"):
        return {"eventSource": source, "eventTime": "2024-01-01T00:00:00Z", "s3": {"bucket": {"name": "lake"}, "object": {"key": key, "size": size}}}

    docs = [
        json.dumps({"Records": [ev("raw/orders/a+b%20c.csv", 10), ev("raw/orders/skip.txt", 10)]}),
        json.dumps({"Records": [ev("raw/orders/x.csv", 5, source="other")]}),
        json.dumps({"NoRecords": []}),
    ]
    df = spark.createDataFrame([(d,) for d in docs], "body string")
    out = parse_events(df, "body", "raw/orders/").collect()
    assert [(r["bucket"], r["key"], r["size"]) for r in out] == [("lake", "raw/orders/a b c.csv", 10)]


def test_scans_by_extension(spark, tmp_dir):
    path = write_csv(tmp_dir, "a.csv", HEADER, baseline_rows(5))
    df = read_raw(spark, path)
    assert df.count() == 5 and dict(df.dtypes)["quantity"] == "int"
    df.write.json(tmp_dir + "/j.json")
    df.write.parquet(tmp_dir + "/p.parquet")
    assert read_raw(spark, tmp_dir + "/j.json").count() == 5
    assert read_raw(spark, tmp_dir + "/p.parquet").count() == 5
    assert format_of("x/Y.PARQUET") == "parquet"


def test_duplicates_with_a_hot_group_of_copies(spark):
    """A group of identical copies holding a third of the rows: exact duplicate and NULL counts."""
    from driftgate.operators.metrics import row_profile

    n = 30_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.col("id").cast("string")).alias("a"),
        F.when(F.col("id") % 3 == 0, F.lit(None).cast("double")).otherwise(F.col("id").cast("double")).alias("b"),
    )
    r = row_profile(df).first()
    assert r["rows"] == n
    assert r["duplicate_records"] == n // 3 - 1  # 10,000 copies -> 9,999 duplicates
    assert r["null_b"] == n // 3 and r["null_a"] == 0


def test_malformed_key_escape_is_not_admitted(spark):
    doc = json.dumps({"Records": [{"eventSource": "aws:s3", "s3": {"bucket": {"name": "b"}, "object": {"key": "raw/orders/bad%zz.csv", "size": 3}}}]})
    out = parse_events(spark.createDataFrame([(doc,)], "body string"), "body", "raw/orders/")
    assert out.count() == 0  # try_url_decode gives NULL instead of failing the job
