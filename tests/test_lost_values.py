"""Lossy and nested casts, rule errors at run time, row prints, data columns that start with an underscore."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from driftgate.operators.evolve import RESCUED, conform
from driftgate.operators.metrics import duplicate_count, null_counts, row_profile
from driftgate.operators.rules import Rule, RuleError, RuleSet
from driftgate.operators.schema_diff import detect, infer_batch_types
from driftgate.operators.validate import failing_rules, validate


def rescued(df, ddl):
    return conform(df, StructType.fromDDL(ddl), rescue=True).first()


def test_lossy_casts_keep_the_original(spark):
    df = spark.sql("SELECT 2.7D AS a, 3.0D AS b, 9007199254740993L AS c, 1.239 AS d, timestamp'2024-01-02 03:04:05' AS e, timestamp'2024-01-02 00:00:00' AS f, '2024-01-02 10:00:00' AS g, cast(null as double) AS h, 1e20D AS i")
    row = rescued(df, "a int, b int, c double, d decimal(10,2), e date, f date, g date, h int, i int")
    assert (row.a, row.b, str(row.d), row.i) == (2, 3, "1.24", None)
    assert set(row[RESCUED]) == {"a", "c", "d", "e", "g", "i"} and row[RESCUED]["a"] == "2.7" and row[RESCUED]["c"] == "9007199254740993"


def test_nested_cells_are_rescued_by_path(spark):
    df = spark.sql("SELECT named_struct('n', 'x', 'm', named_struct('k', 1.5D)) AS s, array(named_struct('n', '1'), named_struct('n', 'y'), null) AS items, array('1', 'z') AS tags")
    row = rescued(df, "s struct<n:int, m:struct<k:int>>, items array<struct<n:int>>, tags array<int>")
    assert row.s.n is None and row.s.m.k == 1 and row["items"][0].n == 1 and row["items"][2] is None and row.tags == [1, None]
    assert row[RESCUED] == {"s.n": "x", "s.m.k": "1.5", "items[1].n": "y", "tags[1]": "z"}
    none = spark.sql("SELECT cast(null as struct<n:string>) AS s, cast(null as array<string>) AS tags")
    assert rescued(none, "s struct<n:int>, tags array<int>")[RESCUED] == {}


def test_rule_errors_are_result_rows(spark):
    df = spark.createDataFrame([("1", 0), ("x", 2), (None, 4)], "a string, b int")
    ansi = spark.conf.get("spark.sql.ansi.enabled")
    rules = RuleSet((Rule.pattern("a", "["), Rule.expr("cast", "CAST(a AS INT) > 0"), Rule.expr("ratio", "4 / b >= 1"), Rule.expr("item", "array(1)[b] = 1"), Rule.not_null("a")))
    by = {r.rule_name: r for r in validate(df, rules).results().collect()}
    assert not by["a_pattern"].passed and by["a_pattern"].total_count == 0 and "[" in by["a_pattern"].error_message
    assert [by[n].failed_count for n in ("cast", "ratio", "item", "a_not_null")] == [2, 1, 2, 1]
    assert spark.conf.get("spark.sql.ansi.enabled") == ansi
    with pytest.raises(RuleError):
        validate(df, RuleSet((Rule.pattern("a", "("),)), on_rule_error="fail")


def test_a_rule_that_raises_is_found_alone(spark):
    df = spark.createDataFrame([(1,), (2,)], "a int")
    rules = RuleSet((Rule.expr("raises", "if(a = 2, raise_error('no'), true)"), Rule.expr("fine", "a > 1")))
    errors = failing_rules(df, rules)
    assert set(errors) == {"raises"}
    got = {r.rule_name: (r.failed_count, r.error_message is None) for r in validate(df, rules, known_errors=errors).results().collect()}
    assert got == {"fine": (1, True), "raises": (0, False)}


def test_prints_tell_rows_apart(spark):
    rows = [(None, "a", None), ("a", None, None), ("a", None, None), ("ab", "c", [None, "x"]), ("a", "bc", ["x", None]), ("a", "bc", ["x", None]), (None, None, None)]
    df = spark.createDataFrame(rows, "x string, y string, z array<string>")
    assert duplicate_count(df).first()[0] == 2
    copies = spark.range(30_000).selectExpr("if(id % 3 = 0, 0, id) as a", "if(id % 3 = 0, double('NaN'), -0.0D) as b")
    profile = row_profile(copies)
    assert (profile.first().duplicate_records, profile.first().null_b, profile.first().rows) == (9_999, 10_000, 30_000)
    wide = spark.createDataFrame([("w" * 50, 1)], "text string, n int")
    plan = duplicate_count(wide)._jdf.queryExecution().executedPlan().toString()
    assert all("text" not in line for line in plan.splitlines() if "Exchange hashpartitioning" in line)


def test_a_data_column_with_an_underscore_is_data(spark):
    registered = StructType.fromDDL("a int")
    change = detect(StructType.fromDDL("a int, _id string, _batch_id string"), registered).changes
    assert [(c.change_type, c.column_name) for c in change] == [("new_column", "_id")]
    df = spark.createDataFrame([(1, None), (1, None), (1, "x")], "a int, _id string")
    assert {r.column_name: r.null_count for r in null_counts(df).collect()} == {"a": 0, "_id": 2} and duplicate_count(df).first()[0] == 1
    assert conform(df, registered, keep_new=False).columns == ["a"] and conform(df, registered).columns == ["a", "_id"]


def test_inference_multiplies_no_rows(spark):
    names = [f"c{i}" for i in range(40)]
    df = spark.range(100).select(F.lit("b").alias("batch"), *[(F.col("id") * 10**i % 10**12).cast("string").alias(c) if i < 12 else F.lit("t").alias(c) for i, c in enumerate(names)])
    out = infer_batch_types(df, "batch")
    plan = out._jdf.queryExecution().executedPlan().toString()
    # each Generate stands above the aggregate that ends its group
    assert plan.count("Generate") == 3 and "SortAggregate" not in plan
    below = plan.split("Exchange")[1:]
    assert all("Generate" not in part.split("Union")[0].split(":  +-")[-1] for part in below if "Scan" in part)
    got = {r.column_name: (r.inferred_type, r.position) for r in out.collect()}
    assert len(got) == 40 and got["c0"] == ("int", 0) and got["c11"][0] == "bigint" and got["c39"] == ("string", 39)


def test_unique_orders_only_repeated_keys(spark):
    df = spark.createDataFrame([(k, o, p) for k, o, p in [(1, 2, 1), (1, 1, 2), (2, 5, 3), (None, 1, 4), (None, 0, 5), (3, None, 6)]], "k int, o int, p int")
    got = validate(df, [Rule.unique("k", order_by=["o", "p"])], row_id=[])
    assert {r.p for r in got.valid.collect()} == {2, 3, 5, 6} and got.invalid.count() == 2
    plan = got.flagged._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and "LeftOuter" in plan


def test_a_batch_outlives_a_rule_that_raises(spark, tmp_dir):
    from driftgate.plans.pipeline import read_layer, run_batch
    from driftgate.settings import TableSpec

    spec = TableSpec("t", tmp_dir + "/lake", date_column=None)
    df = spark.createDataFrame([(1, "x"), (2, None)], "a int, b string")
    rules = RuleSet((Rule.expr("raises", "if(a = 2, raise_error('no'), true)"), Rule.not_null("b")))
    for _ in range(2):  # a retry replaces the metrics rows of its batch
        out = run_batch(spark, df, spec, rules, "one")
    assert out.skipped and read_layer(spark, spec, "clean").count() == 1 and read_layer(spark, spec, "quarantine").count() == 1
    metrics = spark.read.json(spec.metrics_path).collect()
    got = {r.rule_name: "error_message" in r and r.error_message is not None for r in metrics[0].validation_results}
    assert len(metrics) == 1 and got == {"raises": True, "b_not_null": False}
