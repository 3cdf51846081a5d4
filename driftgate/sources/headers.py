"""Headers and inferred types of landed CSV files, many files in one plan.

A dataset's files need not agree on their columns, so one schema for all of
them would misread some.  Here every file is read by position, as text, in one
scan of all files; its first line names its positions.  ``file_types`` has one
row per file and column, which ``operators.schema_diff`` compares with the
registered schema -- one job for thousands of files, and the only thing that is
ever grouped is a file's header (one row) and the kinds of its values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.schema_diff import infer_positions

WIDTH = 64


def _cells(spark: SparkSession, paths: str | list[str], width: int, header: bool, options: dict | None) -> DataFrame:
    """Every record of every file as ``_c0 ...`` with one place to spare, and the file it is from."""
    reader = spark.read.schema(", ".join(f"_c{i} string" for i in range(width + 1)))
    # a declared schema goes by position; with header=True the first line of each file is left out
    for k, v in {"header": header, "enforceSchema": True, "mode": "PERMISSIVE", **(options or {})}.items():
        reader = reader.option(k, v)
    return reader.csv(paths)


def file_headers(spark: SparkSession, paths: str | list[str], width: int = WIDTH, options: dict | None = None) -> DataFrame:
    """``(file, columns)``: the first record of each file.  A file of more than ``width`` columns raises."""
    rows = _cells(spark, paths, width, False, options).select("*", "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("at")).where("file_block_start = 0")
    names = [F.col(f"_c{i}") for i in range(width)]
    wide = F.when(F.col(f"_c{width}").isNotNull(), F.raise_error(F.concat(F.lit(f"more than {width} columns: "), F.col("file_path"))).cast("string"))
    # within a file's first split, records come in order
    first = F.min_by(F.struct(F.array(*names).alias("columns"), F.col(f"_c{width}")), "at")
    heads = rows.groupBy(F.col("file_path").alias("file")).agg(first.alias("h")).select("file", F.col("h.columns").alias("columns"), F.col(f"h._c{width}").alias(f"_c{width}"), F.col("file").alias("file_path"))
    return heads.select("file", F.when(wide.isNull(), F.col("columns")).alias("columns"))


def header_print(columns: Column) -> Column:
    """One number for a header: files that share it have the same columns in the same order."""
    return F.xxhash64(F.to_json(columns, {"ignoreNullFields": "false"}))


def file_types(spark: SparkSession, paths: str | list[str], width: int = WIDTH, options: dict | None = None) -> DataFrame:
    """``(batch, column_name, inferred_type, position)`` with the file as the batch.

    A column without a value, as in a file of a header alone, is ``string``.
    """
    data = _cells(spark, paths, width, True, options).withColumn("file", F.col("_metadata.file_path"))
    types = infer_positions(data, "file", [f"_c{i}" for i in range(width)]).select(F.col("batch").alias("of"), F.col("position").alias("at"), "inferred_type")
    named = file_headers(spark, paths, width, options).select(F.col("file").alias("batch"), F.posexplode("columns").alias("position", "column_name")).where("column_name is not null")
    joined = named.join(types, (F.col("of") == F.col("batch")) & (F.col("at") == F.col("position")), "left")
    return joined.select("batch", "column_name", F.coalesce("inferred_type", F.lit("string")).alias("inferred_type"), "position")
