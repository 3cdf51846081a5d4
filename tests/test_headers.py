"""Landed CSV files: each by its own header, many in one plan."""

from __future__ import annotations

import os

import pytest
from pyspark.sql.types import StructType

from driftgate.operators.schema_diff import diff_batches
from driftgate.sources.headers import file_headers, file_types, header_print
from tests.conftest import SF001

import __spark_entry__ as E

FILES = {
    "a.csv": 'id,amount\n1,2.5\n2,"3"\n',
    "b.csv": 'amount,id\n"1,5",7\n2,8\n',  # another order; a quoted comma is text
    "c.csv": "id,amount,note\n5000000000,1,\n",
    "d.csv": "id\n",  # a header alone
    "e.csv": 'id,"am,ount"\n1,true\n3\n',  # a short record
}


@pytest.fixture()
def landed(tmp_dir):
    for name, text in FILES.items():
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write(text)
    return tmp_dir


def test_each_file_by_its_own_header(spark, landed):
    heads = {r.file[-5:]: [c for c in r.columns if c is not None] for r in file_headers(spark, landed, width=4).collect()}
    assert heads == {"a.csv": ["id", "amount"], "b.csv": ["amount", "id"], "c.csv": ["id", "amount", "note"], "d.csv": ["id"], "e.csv": ["id", "am,ount"]}
    types = {(r.batch[-5:], r.column_name): (r.inferred_type, r.position) for r in file_types(spark, landed, width=4).collect()}
    assert types == {
        ("a.csv", "id"): ("int", 0), ("a.csv", "amount"): ("double", 1),
        ("b.csv", "amount"): ("string", 0), ("b.csv", "id"): ("int", 1),
        ("c.csv", "id"): ("bigint", 0), ("c.csv", "amount"): ("int", 1), ("c.csv", "note"): ("string", 2),
        ("d.csv", "id"): ("string", 0),
        ("e.csv", "id"): ("int", 0), ("e.csv", "am,ount"): ("boolean", 1),
    }
    drift = diff_batches(file_types(spark, landed, width=4), StructType.fromDDL("id int, amount double")).collect()
    got = {(r.batch[-5:], r.change_type, r.column_name) for r in drift}
    assert ("b.csv", "column_order_change", None) in got and ("c.csv", "new_column", "note") in got and ("d.csv", "missing_column", "amount") in got
    assert not [c for f, c, _ in got if f == "a.csv"]


def test_prints_and_width(spark, landed):
    prints = file_headers(spark, landed, width=4)
    assert prints.select(header_print(prints["columns"]).alias("p")).distinct().count() == 5
    with pytest.raises(Exception, match="more than 2 columns"):
        file_headers(spark, landed, width=2).collect()


def test_landed_feed_has_every_change(spark):
    rows = E.queries()["landed_drift"](spark, SF001).collect()
    assert {r.change_type for r in rows} == {"new_column", "missing_column", "datatype_change", "column_order_change"}
    assert {(r.old_type, r.new_type) for r in rows if r.change_type == "datatype_change"} == {("int", "bigint"), ("double", "string")}
