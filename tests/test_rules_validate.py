"""Rule predicates, the split, per-rule results, UNIQUE without windows."""

from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from driftgate.operators.rules import ERROR, INFO, WARNING, Rule, RuleError, RuleSet, orders_rules
from driftgate.operators.validate import FAILED, VALID, validate

SCHEMA = "id string, qty int, price double, code string, day string"


def _df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _failed(spark, rule, rows):
    v = validate(_df(spark, rows), [rule], row_id=["id"] if rule.rule_type == "unique" else None)
    return [r[FAILED] for r in v.flagged.orderBy("id").collect()]


def test_not_null(spark):
    out = _failed(spark, Rule.not_null("qty"), [("a", 1, 1.0, "x", "d"), ("b", None, 1.0, "x", "d")])
    assert out == [[], ["qty_not_null"]]


def test_range_inclusive_and_null_fails(spark):
    rule = Rule.range("qty", min=1, max=3)
    rows = [("a", 1, 0.0, "", ""), ("b", 3, 0.0, "", ""), ("c", 0, 0.0, "", ""), ("d", 4, 0.0, "", ""), ("e", None, 0.0, "", "")]
    assert [bool(x) for x in _failed(spark, rule, rows)] == [False, False, True, True, True]


def test_range_on_text_column_uses_try_cast(spark):
    # ANSI would throw on 'abc' >= 0; the rule treats it as a failure instead
    rule = Rule.range("code", min=0)
    rows = [("a", 1, 0.0, "5", ""), ("b", 1, 0.0, "abc", ""), ("c", 1, 0.0, "-1", "")]
    assert [bool(x) for x in _failed(spark, rule, rows)] == [False, True, True]


def test_datatype(spark):
    rule = Rule.datatype("day", "date")
    rows = [("a", 1, 0.0, "", "2024-01-02"), ("b", 1, 0.0, "", "invalid-date"), ("c", 1, 0.0, "", None)]
    assert [bool(x) for x in _failed(spark, rule, rows)] == [False, True, True]


def test_pattern_unanchored_and_empty_match_fails(spark):
    rule = Rule.pattern("code", r"[A-Z]{3}[0-9]+")
    rows = [("a", 1, 0.0, "xxORD12", ""), ("b", 1, 0.0, "ord12", ""), ("c", 1, 0.0, None, "")]
    assert [bool(x) for x in _failed(spark, rule, rows)] == [False, True, True]
    # a pattern that can match the empty string fails on that match
    empty = Rule.pattern("code", r"[0-9]*", name="digits")
    assert [bool(x) for x in _failed(spark, empty, [("a", 1, 0.0, "abc", "")])] == [True]


def test_custom_expression(spark):
    rule = Rule.expr("qty_times_price", "qty * price < 100")
    rows = [("a", 2, 10.0, "", ""), ("b", 20, 10.0, "", ""), ("c", None, 1.0, "", "")]
    assert [bool(x) for x in _failed(spark, rule, rows)] == [False, True, True]


def test_unique_first_occurrence_null_group(spark):
    df = spark.createDataFrame(
        [("k1", 1), ("k1", 2), ("k2", 3), (None, 4), (None, 5), (None, 6)], "key string, seq int"
    )
    v = validate(df, [Rule.unique("key", order_by=["seq"])], row_id=[])
    got = {r["seq"]: r[VALID] for r in v.flagged.collect()}
    assert got == {1: True, 2: False, 3: True, 4: True, 5: False, 6: False}


def test_unique_identical_copies_exactly_one_passes(spark, tmp_dir):
    # identical rows: the row id (file order) decides; exactly one copy passes
    rows = [("k", "same")] * 50 + [("j", "same")] * 3
    path = tmp_dir + "/copies"
    spark.createDataFrame(rows, "key string, v string").repartition(4).write.parquet(path)
    df = spark.read.parquet(path)
    v = validate(df, [Rule.unique("key")]).flagged
    counts = {r["key"]: r["n"] for r in v.filter(F.col(VALID)).groupBy("key").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts == {"k": 1, "j": 1}
    assert v.count() == 53


def test_unique_matches_window_definition_on_hot_key(spark):
    # a key holding a third of the rows; aggregate + join == row_number over a window
    rnd = random.Random(7)
    rows = [(("hot" if i % 3 == 0 else f"k{rnd.randint(0, 200)}"), i, rnd.randint(0, 5)) for i in range(3000)]
    df = spark.createDataFrame(rows, "key string, id int, w int")
    ours = validate(df, [Rule.unique("key", order_by=["w"])], row_id=["id"]).flagged.select("id", VALID)
    w = Window.partitionBy("key").orderBy("w", "id")
    ref = df.select("id", (F.row_number().over(w) == 1).alias("ref"))
    assert ours.join(ref, "id").filter(F.col(VALID) != F.col("ref")).count() == 0


def test_severity_warning_does_not_invalidate(spark):
    rules = [Rule.not_null("qty", severity=WARNING), Rule.not_null("price", severity=INFO)]
    v = validate(_df(spark, [("a", None, None, "", "")]), rules)
    row = v.flagged.first()
    assert row[VALID] is True
    assert row[FAILED] == ["qty_not_null", "price_not_null"]


def test_no_rules_everything_valid(spark):
    v = validate(_df(spark, [("a", 1, 1.0, "", "")]), [])
    assert v.valid.count() == 1 and v.invalid.count() == 0
    assert v.results().count() == 0


def test_rule_error_reported_not_fatal(spark):
    rules = [Rule.not_null("missing_col"), Rule.pattern("code", ""), Rule.not_null("qty")]
    v = validate(_df(spark, [("a", None, 1.0, "", "")]), rules)
    res = {r["rule_name"]: r for r in v.results().collect()}
    assert res["missing_col_not_null"]["error_message"]
    assert res["missing_col_not_null"]["total_count"] == 0
    assert res["code_pattern"]["error_message"]
    assert res["qty_not_null"]["failed_count"] == 1
    with pytest.raises(RuleError):
        validate(_df(spark, []), [Rule.not_null("missing_col")], on_rule_error="fail")


def test_results_one_aggregate(spark):
    v = validate(_df(spark, [("a", 0, -1.0, "", ""), ("b", 2, 1.0, "", ""), ("c", None, None, "", "")]), [
        Rule.range("qty", min=1, name="q"),
        Rule.range("price", min=0, name="p"),
    ])
    res = {r["rule_name"]: (r["failed_count"], r["total_count"], r["passed"]) for r in v.results().collect()}
    assert res == {"q": (2, 3, False), "p": (2, 3, False)}


def test_ruleset_management():
    rs = RuleSet().add(Rule.not_null("a")).add_all([Rule.not_null("b")])
    assert len(rs) == 2 and [r["rule_name"] for r in rs.to_dict()] == ["a_not_null", "b_not_null"]
    with pytest.raises(RuleError):
        rs.add(Rule.not_null("a"))
    assert len(rs.clear()) == 0
    assert len(orders_rules()) == 6 and all(r.severity == ERROR for r in orders_rules())


@settings(max_examples=15, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.one_of(st.none(), st.sampled_from(["a", "b", "c"])),
            st.one_of(st.none(), st.integers(-2, 3)),
            st.one_of(st.none(), st.floats(-5, 5, allow_nan=False)),
        ),
        max_size=25,
    )
)
def test_valid_plus_invalid_is_total(spark, rows):
    """Three-valued logic never loses a row: NULL predicates count as failures."""
    df = spark.createDataFrame([(r[0], r[1], r[2], str(i)) for i, r in enumerate(rows)], "id string, qty int, price double, n string")
    rules = [
        Rule.not_null("id"),
        Rule.unique("id", order_by=["n"]),
        Rule.range("qty", min=1),
        Rule.range("price", min=0),
    ]
    v = validate(df, rules, row_id=["n"])
    assert v.valid.count() + v.invalid.count() == len(rows)


def test_unique_hot_key_join_is_split_by_aqe(spark):
    """The UNIQUE join-back of a key holding a third of the rows is split by AQE's skew handling."""
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(300_000).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 5000).cast("string")).alias("k"),
            F.col("id"),
        )
        flagged = validate(df, [Rule.unique("k")], row_id=["id"]).flagged.select("k", VALID)
        rows = flagged.collect()
        final_plan = flagged._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in final_plan
        assert sum(1 for r in rows if r[VALID]) == 5001  # one first occurrence per key
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_range_with_decimal_bounds(spark):
    from decimal import Decimal

    df = spark.createDataFrame([("a", "10.5"), ("b", "9.99"), ("c", "x")], "id string, v string")
    v = validate(df, [Rule.range("v", min=Decimal("10.00"), max=Decimal("20.00"))])
    got = {r["id"]: r[VALID] for r in v.flagged.collect()}
    assert got == {"a": True, "b": False, "c": False}


def test_rule_columns_resolve_like_spark(spark):
    df = spark.createDataFrame([("a", None), ("b", 2)], "ID string, Qty int")
    v = validate(df, [Rule.not_null("qty"), Rule.unique("id")])
    assert not v.rule_errors
    assert sorted(r[VALID] for r in v.flagged.collect()) == [False, True]


def test_datatype_decimal_and_pattern_on_numbers(spark):
    df = spark.createDataFrame([("a", "12.34", 120), ("b", "12.3456789012345", 7), ("c", "x", None)], "id string, v string, n int")
    v = validate(df, [Rule.datatype("v", "decimal(10,2)"), Rule.pattern("n", r"^[0-9]{3}$", name="three_digits")])
    got = {r["id"]: sorted(r[FAILED]) for r in v.flagged.collect()}
    # a value that rounds into decimal(10,2) passes; text that is no number fails
    assert got == {"a": [], "b": ["three_digits"], "c": ["three_digits", "v_datatype"]}
