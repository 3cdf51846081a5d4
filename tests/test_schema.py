"""Drift detection, conform/evolve, registry."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DecimalType,
    FloatType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from driftgate.operators.evolve import RESCUED, SchemaDriftError, conform, evolve, evolved_schema
from driftgate.operators.registry import SchemaRegistry, add_catalog_columns, catalog_schema
from driftgate.operators.schema_diff import (
    COLUMN_ORDER_CHANGE,
    DATATYPE_CHANGE,
    MISSING_COLUMN,
    NEW_COLUMN,
    detect,
    diff_batches,
    infer_batch_types,
    infer_cell_types,
)


def S(*fields):
    return StructType([StructField(n, t) for n, t in fields])


REG = S(("a", StringType()), ("b", IntegerType()), ("c", DecimalType(10, 2)))


def kinds(cmp):
    return [(c.change_type, c.column_name) for c in cmp.changes]


def test_new_missing_type_order():
    inc = S(("b", LongType()), ("a", StringType()), ("d", StringType()))
    cmp = detect(inc, REG)
    assert kinds(cmp) == [
        (NEW_COLUMN, "d"),
        (MISSING_COLUMN, "c"),
        (DATATYPE_CHANGE, "b"),
        (COLUMN_ORDER_CHANGE, None),
    ]
    order = cmp.by_type(COLUMN_ORDER_CHANGE)[0].details
    assert json.loads(order["catalog_order"]) == ["a", "b", "c"]
    assert not cmp.is_backward_compatible  # a missing column


def test_backward_compatibility_safe_widening():
    assert detect(S(("a", StringType()), ("b", LongType()), ("c", DecimalType(10, 2)), ("z", StringType())), REG).is_backward_compatible
    assert not detect(S(("a", StringType()), ("b", StringType()), ("c", DecimalType(10, 2))), REG).is_backward_compatible
    float_reg = S(("x", FloatType()))
    assert detect(S(("x", DoubleType())), float_reg).is_backward_compatible


def test_decimal_precision_is_kept():
    cmp = detect(S(("a", StringType()), ("b", IntegerType()), ("c", DecimalType(12, 4))), REG)
    assert [(c.old_type, c.new_type) for c in cmp.changes] == [("decimal(10,2)", "decimal(12,4)")]
    assert not detect(S(("a", StringType()), ("b", IntegerType()), ("c", DecimalType(10, 2))), REG).has_changes


def test_new_table_and_lineage_columns():
    cmp = detect(REG, None)
    assert cmp.is_new_table and not cmp.has_changes and cmp.is_backward_compatible
    # columns starting with '_' are not part of the compared schema
    assert not detect(StructType(REG.fields + [StructField("_ingest_ts", StringType())]), REG).has_changes


def test_case_insensitive_by_default():
    assert not detect(S(("A", StringType()), ("b", IntegerType()), ("C", DecimalType(10, 2))), REG, case_sensitive=False).has_changes
    assert detect(S(("A", StringType()), ("b", IntegerType()), ("c", DecimalType(10, 2))), REG, case_sensitive=True).has_changes


def test_nested_drift_by_dotted_path():
    reg = S(("id", StringType()), ("addr", S(("city", StringType()), ("zip", IntegerType()))))
    inc = S(("id", StringType()), ("addr", S(("city", StringType()), ("zip", StringType()), ("street", StringType()))))
    assert kinds(detect(inc, reg)) == [(NEW_COLUMN, "addr.street"), (DATATYPE_CHANGE, "addr.zip")]


def test_to_df_and_json(spark):
    cmp = detect(S(("a", StringType()), ("d", StringType())), REG)
    df = cmp.to_df(spark)
    assert df.count() == 3
    assert json.loads(cmp.to_json())["has_changes"] is True


def test_conform_casts_adds_reorders_rescues(spark):
    df = spark.createDataFrame([("x", "12", "bad", "n1"), ("y", "7", "3.456", "n2")], "a string, b string, c string, extra string")
    out = conform(df.select("extra", "c", "a", "b"), REG, keep_new=True, rescue=True)
    assert out.columns == ["a", "b", "c", "extra", RESCUED]
    rows = {r["a"]: r for r in out.collect()}
    assert rows["x"]["b"] == 12 and rows["x"]["c"] is None and rows["x"][RESCUED] == {"c": "bad"}
    assert str(rows["y"]["c"]) == "3.46" and rows["y"][RESCUED] == {}


def test_evolve_modes(spark):
    df = spark.createDataFrame([("x", 1, "n")], "a string, b int, extra string")
    cmp = detect(df.schema, REG)
    evolved = evolve(df, cmp, mode="evolve")
    assert evolved.columns == ["a", "b", "c", "extra"]  # missing c added as NULL, catalog order, then new
    matched = evolve(df, cmp, mode="match")
    assert matched.schema.simpleString() == REG.simpleString()  # exactly the catalog schema
    with pytest.raises(SchemaDriftError):
        evolve(df, cmp, mode="strict")
    assert evolve(df, detect(df.schema, df.schema)) is df  # E1 pass-through
    assert [f.name for f in evolved_schema(cmp).fields] == ["a", "b", "c", "extra"]


def test_evolve_is_idempotent(spark):
    df = spark.createDataFrame([("x", "1", "2.5", "q")], "a string, b string, c string, extra string")
    once = evolve(df, detect(df.schema, REG))
    twice = evolve(once, detect(once.schema, evolved_schema(detect(df.schema, REG))))
    assert once.schema == twice.schema and once.collect() == twice.collect()


def test_conform_nested_struct(spark):
    reg = S(("id", StringType()), ("addr", S(("city", StringType()), ("zip", IntegerType()))))
    df = spark.createDataFrame([("1", ("Oslo", "0150", "Main")), ("2", None)], "id string, addr struct<city:string, zip:string, street:string>")
    out = conform(df, reg, keep_new=False)
    assert out.schema.simpleString() == reg.simpleString()
    rows = {r["id"]: r["addr"] for r in out.collect()}
    assert rows["1"]["zip"] == 150 and rows["2"] is None


def test_registry_versions(spark, tmp_dir):
    reg = SchemaRegistry(spark, tmp_dir + "/registry")
    assert reg.get("t") is None
    assert reg.publish("t", REG) == 1
    assert reg.publish("t", REG) == 1  # unchanged schema: no new version
    bigger = StructType(REG.fields + [StructField("d", StringType())])
    assert reg.publish("t", bigger) == 2
    assert reg.get("t").simpleString() == bigger.simpleString()
    assert reg.history("t").count() == 2


def test_catalog_schema_and_add_columns(spark, tmp_dir):
    spark.sql("DROP TABLE IF EXISTS cat_t")
    spark.sql(f"CREATE TABLE cat_t (a string, b int, year int) USING parquet PARTITIONED BY (year) LOCATION '{tmp_dir}/cat_t'")
    assert catalog_schema(spark, "cat_t").fieldNames() == ["a", "b"]
    add_catalog_columns(spark, "cat_t", S(("c", StringType())))
    assert catalog_schema(spark, "cat_t").fieldNames() == ["a", "b", "c"]
    assert catalog_schema(spark, "no_such_table") is None


def test_batch_inference_and_diff(spark):
    rows = [
        ("d1", "1", "2.5", "2024-01-01", "x"),
        ("d1", "2", "3", "2024-01-02", "y"),
        ("d2", "3", "abc", "invalid-date", "z"),
        ("d2", None, "4", "2024-01-03", None),
    ]
    df = spark.createDataFrame(rows, "batch string, b string, c string, d string, a string")
    types = {(r["batch"], r["column_name"]): r["inferred_type"] for r in infer_batch_types(df, "batch").collect()}
    assert types[("d1", "b")] == "int" and types[("d1", "c")] == "double" and types[("d1", "d")] == "date"
    assert types[("d2", "c")] == "string" and types[("d2", "d")] == "string"
    reg = S(("a", StringType()), ("b", IntegerType()), ("c", DecimalType(10, 2)), ("d", StringType()), ("e", StringType()))
    changes = diff_batches(infer_batch_types(df, "batch"), reg).collect()
    got = sorted((r["batch"], r["change_type"], r["column_name"]) for r in changes)
    assert ("d1", MISSING_COLUMN, "e") in got
    assert ("d1", DATATYPE_CHANGE, "c") in got and ("d1", DATATYPE_CHANGE, "d") in got
    assert ("d2", DATATYPE_CHANGE, "c") in got and ("d2", DATATYPE_CHANGE, "d") not in got
    assert ("d1", COLUMN_ORDER_CHANGE, None) in got  # a comes last in the batch, first in the registry


def test_inference_evaluates_each_pattern_once_a_value(spark):
    df = spark.createDataFrame([("d", "1")], "batch string, a string")
    plan = infer_batch_types(df, "batch")._jdf.queryExecution()
    code = plan.explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen"))
    if "matcher(" not in code:  # an adaptive plan shows its code once it has run
        plan.toRdd().count()
        code = plan.explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen"))
    # a number, a date and a timestamp pattern, each at one place for the column
    assert code.count(".matcher(") == 3 and code.count("toLongExact(") <= 2


def test_inferred_types_of_odd_values(spark):
    kinds = {
        "int": ["0", "-7", "+7", "2147483647", "-2147483648", "007", "12\n", "0000000000000000000000001"],
        "bigint": ["2147483648", "-2147483649", "9223372036854775807", "-9223372036854775808"],
        "double": ["1.", ".5", "-1.5e-3", "1E5", "1e+05", "+.5e1", "9223372036854775808", "123e-5", "1.5\n", "12\u0085"],
        "date": ["2024-02-29", "0001-01-01", "2024-01-01\n", "2024-01-01\r\n"],
        "timestamp": ["2024-01-01 10:00", "2024-01-01T10:00:01", "2024-01-01 10:00:01.123456"],
        "boolean": ["true", "FALSE", "fAlse"],
        "string": ["", " ", ".", "+", "-", ",", "/1", ",5", "e5", "1e", "1e+", "1.2.3", "12-34", "1 2", " 1", "2024-13-01", "2024-01-01 25:00", "2024-01-01x",
                   "tree", "False ", "nan", "\u0661", "1\u0661", "12a", "12345678-1", "TRUE\n", "2024-01-01\n\n", "0x10", "1f", "1L"],
    }
    one = [(f"{k}{i}", v) for k, values in kinds.items() for i, v in enumerate(values)]
    both = [("int+bigint", "1"), ("int+bigint", "2147483648"), ("bigint+double", "2147483648"), ("bigint+double", ".5"), ("int+date", "1"), ("int+date", "2024-01-01"),
            ("date+timestamp", "2024-01-01"), ("date+timestamp", "2024-01-01 10:00"), ("int+none", "1"), ("int+none", None), ("none", None), ("int+string", "1"), ("int+string", "x")]
    df = spark.createDataFrame(one + both, "batch string, v string")
    want = {f"{k}{i}": k for k, values in kinds.items() for i in range(len(values))}
    want |= {"int+bigint": "bigint", "bigint+double": "double", "int+date": "string", "date+timestamp": "string", "int+none": "int", "none": "string", "int+string": "string"}
    assert {r.batch: r.inferred_type for r in infer_batch_types(df, "batch").collect()} == want
    cells = df.selectExpr("batch", "0 AS position", "'v' AS column_name", "v AS value")
    assert {r.batch: r.inferred_type for r in infer_cell_types(cells).collect()} == want


def test_conform_array_of_structs_and_array_type_change(spark):
    reg = S(("id", StringType()), ("items", ArrayType(S(("sku", StringType()), ("qty", IntegerType())))))
    df = spark.createDataFrame(
        [("1", [("a", "2"), ("b", "x")]), ("2", None)], "id string, items array<struct<sku:string, qty:string>>"
    )
    cmp = detect(df.schema, reg)
    # the array's element type differs: reported as one datatype change of the array column
    assert [(c.change_type, c.column_name) for c in cmp.changes] == [(DATATYPE_CHANGE, "items")]
    out = conform(df, reg, keep_new=False)
    rows = {r["id"]: r["items"] for r in out.collect()}
    assert [(x["sku"], x["qty"]) for x in rows["1"]] == [("a", 2), ("b", None)]
    assert rows["2"] is None
