"""Registered queries whose data make each answer occur."""

from pyspark.sql.types import StructType

import __spark_entry__ as E
from driftgate.operators.schema_diff import diff_batches, infer_cell_types
from tests.conftest import SF001


def test_feed_drift_has_every_change(spark):
    rows = E.queries()["feed_drift"](spark, SF001).collect()
    assert {r.change_type for r in rows} == {"new_column", "missing_column", "datatype_change", "column_order_change"}
    assert {(r.old_type, r.new_type) for r in rows if r.change_type == "datatype_change"} == {("int", "bigint"), ("double", "string")}
    answers = E.queries()["feed_compatibility"](spark, SF001)
    assert {(bool(r.change_count), r.is_backward_compatible) for r in answers.collect()} == {(False, True), (True, True), (True, False)}


def test_cells_of_an_empty_and_an_all_null_column(spark):
    schema = "batch string, position int, column_name string, value string"
    registered = StructType.fromDDL("a int")
    assert infer_cell_types(spark.createDataFrame([], schema)).count() == 0
    cells = spark.createDataFrame([("x", 0, "a", None), ("y", 0, "a", "1"), ("y", 0, "a", None)], schema)
    got = diff_batches(infer_cell_types(cells), registered).collect()
    assert [(r.batch, r.old_type, r.new_type) for r in got] == [("x", "int", "string")]


def test_balance_and_summary_cover_every_raw_row(spark):
    b = E.queries()["validation_balance"](spark, SF001).first()
    assert b.valid and b.invalid and b.valid + b.invalid == b.total
    assert sum(r["count"] for r in E.queries()["quality_summary"](spark, SF001).collect()) == b.total


def test_rule_types_pass_and_fail_by_row(spark):
    by = {r.rule_name: r for r in E.queries()["rule_types"](spark, SF001).collect()}
    assert {r.severity for r in by.values()} == {"error", "warning", "info"}
    for name in ("order_date_datatype", "order_id_pattern", "price_below_1500"):
        assert 0 < by[name].failed_count < by[name].total_count
    assert by["coupon_not_null"].total_count == 0 and not by["coupon_not_null"].passed
