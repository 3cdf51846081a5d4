"""Valid plus invalid is every row, NULLs in keys, order columns and batch ids included."""

import pytest

from driftgate.operators.rules import Rule, RuleError, RuleSet
from driftgate.operators.validate import validate
from driftgate.sinks.writers import remove_batch


@pytest.mark.parametrize("order", [["o"], ["o", "p"]])
def test_unique_keeps_rows_with_null_order(spark, order):
    rows = [(1, None, 1), (1, 5, 1), (2, None, 2), (None, 1, 3), (None, None, 4)]
    df = spark.createDataFrame(rows, "k int, o int, p int")
    got = validate(df, RuleSet((Rule.unique("k", order_by=order),)), row_id=[])
    valid, invalid = got.valid.collect(), got.invalid.collect()
    assert len(valid) + len(invalid) == 5
    assert (1, 5) in {(r.k, r.o) for r in valid} and (1, None) in {(r.k, r.o) for r in invalid}


def test_duplicate_rule_names_are_refused():
    with pytest.raises(RuleError):
        RuleSet((Rule.not_null("a", name="n"), Rule.not_null("b", name="n")))


def test_remove_batch_keeps_rows_without_a_batch(spark, tmp_dir):
    path = f"{tmp_dir}/clean"
    rows = [(1, "b1", "d"), (2, "b2", "d"), (3, None, "d")]
    spark.createDataFrame(rows, "id int, _batch_id string, day string").write.partitionBy("day").parquet(path)
    remove_batch(spark, path, "b1", ["day"])
    assert {r.id for r in spark.read.parquet(path).collect()} == {2, 3}
    remove_batch(spark, f"{tmp_dir}/nothing", "b1", ["day"])
