"""Registered schemas.

Two places can hold the schema a dataset must fit:

* a catalog table -- its columns minus the partition columns;
* a versioned registry table of ours: append-only rows
  ``(table_name, version, schema_json, batch_id, registered_at)`` stored as
  Parquet under ``TableSpec.registry_path``.  Publishing a schema appends a
  version; reading takes the newest.  Nothing is overwritten, so a failed
  publish leaves the previous version in force.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.types import all_nullable
from ..sinks.writers import path_exists

REGISTRY_SCHEMA = "table_name string, version int, schema_json string, batch_id string, registered_at timestamp"


def catalog_schema(spark: SparkSession, table: str) -> StructType | None:
    """S12 against the catalog: None when the table does not exist."""
    if not spark.catalog.tableExists(table):
        return None
    parts = {c.name for c in spark.catalog.listColumns(table) if c.isPartition}
    schema = spark.table(table).schema
    return all_nullable(StructType([f for f in schema.fields if f.name not in parts]))


def add_catalog_columns(spark: SparkSession, table: str, new_fields: StructType) -> None:
    """S13 against the catalog: top-level additions via ALTER TABLE ... ADD COLUMNS."""
    if not new_fields.fields:
        return
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new_fields.fields)
    spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({cols})")


class SchemaRegistry:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def _read(self) -> DataFrame | None:
        if not path_exists(self.spark, self.path):
            return None  # no version published yet; an unreadable registry raises
        return self.spark.read.schema(REGISTRY_SCHEMA).parquet(self.path)

    def history(self, table_name: str) -> DataFrame:
        df = self._read()
        if df is None:
            return self.spark.createDataFrame([], REGISTRY_SCHEMA)
        return df.filter(F.col("table_name") == table_name)

    def latest(self, table_name: str) -> tuple[int, StructType] | None:
        # One row per published version: a handful, never data-sized.
        row = self.history(table_name).orderBy(F.desc("version")).select("version", "schema_json").first()
        if row is None:
            return None
        return int(row["version"]), StructType.fromJson(json.loads(row["schema_json"]))

    def get(self, table_name: str) -> StructType | None:
        found = self.latest(table_name)
        return None if found is None else found[1]

    def publish(self, table_name: str, schema: StructType, batch_id: str | None = None) -> int:
        found = self.latest(table_name)
        if found is not None and found[1].simpleString() == schema.simpleString():
            return found[0]
        version = 1 if found is None else found[0] + 1
        row = self.spark.createDataFrame(
            [(table_name, version, json.dumps(schema.jsonValue()), batch_id)],
            "table_name string, version int, schema_json string, batch_id string",
        ).withColumn("registered_at", F.current_timestamp())
        row.coalesce(1).write.mode("append").parquet(self.path)
        return version
