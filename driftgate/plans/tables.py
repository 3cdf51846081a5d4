"""Table management (S14-S22) as Spark SQL statements and DataFrame writes.

The statements are the ones a Spark user types; they run on any catalog
Spark is configured with (the in-memory one in tests).
"""

from __future__ import annotations

import datetime as _dt
import time
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.lineage import BATCH_ID, FAILED, LINEAGE, RESCUED, VALID
from ..operators.evolve import conform
from ..operators.rules import RuleSet
from ..operators.uniqueness import with_held
from ..operators.validate import validate
from ..session import ensure_checkpoint_dir
from ..settings import TableSpec
from ..sinks.writers import delete, path_exists, remove_batch, rewrite_partitions, with_partitions, write_partitioned
from .pipeline import committed, log_success, read_layer, read_run_log

PARTITION_DDL = "year INT, month INT, day INT"


def _cols_ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def create_table_sql(table: str, schema: StructType, location: str, extra: str = "") -> str:
    cols = _cols_ddl(schema) + (f", {extra}" if extra else "")
    return (
        f"CREATE TABLE IF NOT EXISTS {table} ({cols}, {PARTITION_DDL}) "
        f"USING parquet PARTITIONED BY (year, month, day) LOCATION '{location}'"
    )


def create_tables(spark: SparkSession, spec: TableSpec, schema: StructType, database: str | None = None) -> tuple[str, str]:
    """External, partitioned Parquet tables for the clean and quarantine layers."""
    prefix = f"{database}." if database else ""
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    clean, quarantine = f"{prefix}clean_{spec.name}", f"{prefix}quarantine_{spec.name}"
    spark.sql(create_table_sql(clean, schema, spec.clean_path, f"`{BATCH_ID}` string"))
    spark.sql(
        create_table_sql(
            quarantine,
            schema,
            spec.quarantine_path,
            f"`{BATCH_ID}` string, `quarantine_timestamp` timestamp, `_failed_rules` array<string>, `_rescued` map<string,string>",
        )
    )
    return clean, quarantine


def discover_partitions(spark: SparkSession, table: str) -> None:
    """MSCK REPAIR TABLE."""
    spark.sql(f"MSCK REPAIR TABLE {table}")


def _spec(year: int | None, month: int | None, day: int | None) -> str:
    at = [f"{c}={'NULL' if v is None else int(v)}" for c, v in (("year", year), ("month", month), ("day", day))]
    return f"PARTITION ({', '.join(at)})"


def add_partition(spark: SparkSession, table: str, year: int, month: int, day: int, location: str | None = None) -> None:
    """S16."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {_spec(year, month, day)}{loc}")


def drop_partition(spark: SparkSession, table: str, year: int, month: int, day: int) -> None:
    """S17 (an external table keeps its files)."""
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {_spec(year, month, day)}")


def describe(spark: SparkSession, table: str) -> dict[str, DataFrame]:
    """DESCRIBE, SHOW TBLPROPERTIES, SHOW COLUMNS."""
    return {
        "describe": spark.sql(f"DESCRIBE {table}"),
        "properties": spark.sql(f"SHOW TBLPROPERTIES {table}"),
        "columns": spark.sql(f"SHOW COLUMNS IN {table}"),
    }


def daily_sales_summary_sql(clean_table: str) -> str:
    """The S19 view body in Spark SQL (averages rounded half-up exactly)."""
    cents = "CAST(SUM(price * quantity) * 100 AS DECIMAL(38,0))"
    n = "CAST(COUNT(price * quantity) * 100 AS DECIMAL(38,0))"  # cents / (100 n) = average
    return f"""
SELECT order_date, region,
       COUNT(DISTINCT order_id) AS total_orders,
       COUNT(DISTINCT customer_id) AS unique_customers,
       CAST(SUM(quantity) AS BIGINT) AS total_items,
       CAST(ROUND(SUM(price * quantity), 2) AS DOUBLE) AS total_revenue,
       CAST(div({cents} * 200 + {n}, {n} * 2) AS DOUBLE) / 100.0 AS avg_order_value
FROM {clean_table}
WHERE status = 'completed'
GROUP BY order_date, region"""


def create_summary_view(spark: SparkSession, clean_table: str, view: str = "daily_sales_summary", temporary: bool = False) -> None:
    """CREATE OR REPLACE VIEW."""
    kind = "TEMPORARY VIEW" if temporary else "VIEW"
    spark.sql(f"CREATE OR REPLACE {kind} {view} AS {daily_sales_summary_sql(clean_table)}")


def materialize(df: DataFrame, path: str, partition_by=("year", "month", "day")) -> None:
    """Curated layer; re-running replaces only the partitions present in ``df``."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


PARTITION_OF = r"(year=[^/]+/month=[^/]+/day=[^/]+)/[^/]+$"


def expired_partitions(spark: SparkSession, path: str, as_of: _dt.date, max_age_days: int) -> DataFrame:
    """``(partition, year, month, day)`` of the partitions under ``path`` to drop.

    Decided from partition values and file times alone; files are listed, not
    read.  A partition goes when its date is older than ``max_age_days`` and no
    file came in within that time: an old order that arrived late stays as long
    as any.  The partition without a date goes by its files alone.  Files newer
    than ``as_of`` were not there on that day and do not count.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    part = F.regexp_extract("path", PARTITION_OF, 1)
    age = F.datediff(F.lit(as_of), F.col("modificationTime").cast("date"))
    lately = F.max(F.coalesce((age >= 0) & (age <= max_age_days), F.lit(False)))
    parts = files.select("path", "modificationTime").groupBy(part.alias("partition")).agg(lately.alias("lately")).where("partition <> ''")
    values = {c: F.regexp_extract("partition", rf"{c}=([^/]+)", 1).try_cast("int").alias(c) for c in ("year", "month", "day")}
    dated = parts.select("partition", "lately", *values.values())
    date = F.concat_ws("-", "year", "month", "day").try_cast("date")
    old = date.isNull() | (F.datediff(F.lit(as_of), date) > max_age_days)
    return dated.where(old & ~F.col("lately")).select("partition", "year", "month", "day")


def apply_retention(spark: SparkSession, table: str, as_of: _dt.date, max_age_days: int) -> int:
    """S22 -> S17: drop every expired partition from the catalog and delete its files; returns how many.

    The list has one row per day partition, bounded by the table's age in days."""
    described = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").first()
    location = described["data_type"].rstrip("/")
    parts = expired_partitions(spark, location, as_of, max_age_days).collect()
    # one statement per chunk of partitions, not one catalog call per day
    for i in range(0, len(parts), 500):
        specs = ", ".join(_spec(r["year"], r["month"], r["day"]) for r in parts[i : i + 500])
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for r in parts:
        p = jvm.org.apache.hadoop.fs.Path(f"{location}/{r['partition']}")
        p.getFileSystem(conf).delete(p, True)
    return len(parts)


def _ready(spark: SparkSession, path: str) -> list[str]:
    """The reprocessing batch whose verdicts under ``path`` are complete, if there is one."""
    if not path_exists(spark, f"{path}/ready"):
        return []
    return [r["batch_id"] for r in spark.read.schema("batch_id string").json(f"{path}/ready").collect()]  # one row


def _judged(spark: SparkSession, spec: TableSpec, registered: StructType, rules: RuleSet, text_columns: tuple[str, ...], unique_key: str | None) -> DataFrame:
    """Every quarantined row of a committed batch: as it would be typed now, its verdict, and ``_was``, the row as it lies there."""
    q = spark.read.option("mergeSchema", "true").parquet(spec.quarantine_path)
    done = read_run_log(spark, spec).where("success").select(F.col("batch_id").alias(BATCH_ID)).distinct()
    # a written copy: UNIQUE reads its rows in several branches, which must number them alike
    q = q.join(done, BATCH_ID, "left_semi").select(*q.columns).checkpoint(eager=True)
    body = q.withColumn("_was", F.struct(*q.columns))
    if RESCUED in q.columns:
        body = body.withColumns({c: F.coalesce(F.col(c), F.col(RESCUED)[c]) for c in text_columns if c in q.columns})
    body = body.drop(FAILED, RESCUED, BATCH_ID, "quarantine_timestamp", *spec.partition_by)
    typed = conform(body, registered, keep_new=False, rescue=True, lineage={*LINEAGE, "_was"})
    flagged = validate(typed, rules).flagged
    if unique_key and path_exists(spark, spec.clean_path):
        held = F.col("_held_before")
        reason = F.array_union(F.col(FAILED), F.array(F.lit(f"{unique_key}_exists_in_clean")))
        flagged = with_held(flagged, read_layer(spark, spec), unique_key, "_held_before")
        flagged = flagged.withColumns({VALID: F.col(VALID) & ~held, FAILED: F.when(held, reason).otherwise(F.col(FAILED))}).drop("_held_before")
    return flagged.drop(RESCUED)


def reprocess_quarantine(
    spark: SparkSession,
    spec: TableSpec,
    registered: StructType,
    rules: RuleSet,
    batch_id: str,
    text_columns: tuple[str, ...] | None = None,
    unique_key: str | None = None,
) -> DataFrame:
    """Re-type and re-validate quarantined rows; promote the ones that pass.

    A batch of the run log like any other: a committed ``batch_id`` changes
    nothing again, and an attempt that broke off is carried to its end.  The
    verdicts are written beside the logs before either layer changes; a retry
    takes them as they are, removes what the earlier attempt appended to the
    clean layer, and does the same writes again, so no row is lost or doubled
    wherever it stopped.  While a reprocessing is unfinished, another one is
    refused.

    Rows of batches without a commit are left alone.  Rows that stay keep every
    column, their batch and their time; only the failed rules are the new ones.
    Only partitions where a row leaves or its failed rules change are rewritten,
    with the rows that came in meanwhile.  A key (of the UNIQUE rule, or
    ``unique_key``) that the clean layer already holds is not promoted.  The run
    log counts promoted rows as valid and no longer invalid, and none as new.
    Returns the promoted rows, read from the clean layer.
    """
    ensure_checkpoint_dir(spark)
    text_columns = spec.quarantine_text_columns if text_columns is None else text_columns
    if unique_key is None:  # the key of the rule set's UNIQUE rule, if it has one
        unique_key = next((r.column for r in rules if r.rule_type == "unique"), None)
    staged, parts, started = f"{spec.logs_path}/reprocess", list(spec.partition_by), time.time()

    def promoted_rows() -> DataFrame:
        return read_layer(spark, replace(spec, registered_schema=registered)).where(F.col(BATCH_ID) == batch_id)

    if not path_exists(spark, spec.quarantine_path) or not path_exists(spark, spec.run_log_path):
        return spark.createDataFrame([], registered)  # nothing was ever quarantined
    if committed(spark, spec, batch_id):
        return promoted_rows()
    unfinished = _ready(spark, staged)
    if unfinished and unfinished != [batch_id] and not committed(spark, spec, unfinished[0]):
        raise RuntimeError(f"reprocessing {unfinished[0]!r} is unfinished: run it again first")
    if unfinished == [batch_id]:
        remove_batch(spark, spec.clean_path, batch_id, parts)
    else:
        delete(spark, staged)
        _judged(spark, spec, registered, rules, text_columns, unique_key).write.parquet(f"{staged}/verdicts")
        spark.range(1).select(F.lit(batch_id).alias("batch_id")).coalesce(1).write.json(f"{staged}/ready")

    verdicts = spark.read.parquet(f"{staged}/verdicts")
    promoted = verdicts.where(VALID).drop(FAILED, VALID, "_was").withColumn(BATCH_ID, F.lit(batch_id))
    write_partitioned(with_partitions(promoted, spec.date_column), spec.clean_path, parts)

    changed = F.col(VALID) | ~F.sort_array(FAILED).eqNullSafe(F.sort_array(F.col("_was")[FAILED]))
    touched = verdicts.where(changed).select(*[F.col("_was")[c].alias(c) for c in parts]).distinct()
    days = [tuple(r) for r in touched.collect()]  # one row per day partition
    if days:
        stay = verdicts.where(~F.col(VALID)).select(F.col("_was").withField(FAILED, F.col(FAILED)).alias("r")).select("r.*")
        judged = verdicts.select(F.col("_was")[BATCH_ID].alias(BATCH_ID)).distinct()
        table = spark.read.option("mergeSchema", "true").parquet(spec.quarantine_path)
        others = table.join(judged, BATCH_ID, "left_anti").select(*table.columns)
        keep = stay.unionByName(others, allowMissingColumns=True)
        t = touched.select(*[F.col(c).alias(f"_t_{c}") for c in parts])
        keep = keep.join(t, [keep[c].eqNullSafe(t[f"_t_{c}"]) for c in parts], "left_semi")
        rewrite_partitions(spark, spec.quarantine_path, keep.checkpoint(eager=True), days, parts)

    n = verdicts.where(VALID).count()
    log_success(spark, spec, batch_id, started, total=0, valid=n, invalid=-n)
    delete(spark, staged)
    return promoted_rows()
