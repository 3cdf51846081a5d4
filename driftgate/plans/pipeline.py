"""The batch pipeline (M11): one incoming batch into the lake.

detect drift (D) -> conform (E) -> validate (V) -> clean + quarantine writes
(S8-S10) -> metrics, alerts, schema publish, run log (M, S11, S13).

Jobs per batch: the raw batch is read by the flagged plan (again by the
branches of a UNIQUE rule), the flagged rows are persisted once with their
row prints and NULL cells, then two writes and the metrics read those.  A lost
executor only loses cached blocks, which Spark recomputes from the (file
scan) lineage; the row ids used by UNIQUE are stable under that recompute
because they are assigned right after the file scan.

Idempotence: every row carries ``_batch_id`` and a batch is marked as started
before it writes; a batch found in the run log is skipped, the rows of one that
was started but never reached the run log are removed first and then redone.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.lineage import FAILED, NULL_CELLS, RESCUED, ROW_PRINT, VALID
from ..operators.alerts import check_thresholds
from ..operators.evolve import SchemaDriftError, evolve, evolved_schema
from ..operators.metrics import business_columns, collect_metrics, profile_columns
from ..operators.registry import SchemaRegistry, add_catalog_columns, catalog_schema
from ..operators.rules import RuleSet
from ..operators.schema_diff import Comparison, detect
from ..operators.uniqueness import with_held
from ..operators.validate import Validated, failing_rules, validate
from ..settings import TableSpec
from ..sinks.writers import BATCH_ID, path_exists, remove_batch, to_quarantine, with_partitions, write_partitioned, write_rows

SCHEMA_INCOMPATIBLE = "schema_incompatible"

RUN_LOG_SCHEMA = (
    "table_name string, batch_id string, success boolean, started_at timestamp, duration_sec double, "
    "total_records bigint, valid_records bigint, invalid_records bigint, data_quality_score double, "
    "schema_changes int, alerts int, error string"
)


@dataclass
class BatchOutcome:
    batch_id: str
    skipped: bool = False
    empty: bool = False
    comparison: Comparison | None = None
    metrics: dict = field(default_factory=dict)
    alerts: list[dict] = field(default_factory=list)
    duration_sec: float = 0.0


@dataclass
class Prepared:
    """The lazy plans of one batch, before anything is written."""

    comparison: Comparison
    conformed: DataFrame
    validated: Validated

    @property
    def valid(self) -> DataFrame:
        return self.validated.valid.drop(RESCUED)

    def quarantine(self, timestamp: Column | None = None, text_columns=()) -> DataFrame:
        return to_quarantine(self.validated.invalid, timestamp, text_columns)


def prepare(
    raw: DataFrame,
    registered,
    rules: RuleSet,
    mode: str = "evolve",
    row_id: list[str] | None = None,
) -> Prepared:
    comparison = detect(raw.schema, registered)
    conformed = evolve(raw, comparison, mode=mode, rescue=True)
    if RESCUED not in conformed.columns:
        conformed = conformed.withColumn(RESCUED, F.create_map().cast("map<string,string>"))
    validated = validate(conformed, rules, row_id=row_id)
    return Prepared(comparison, conformed, validated)


# The run log is partitioned by a hash bucket of the batch id, so the commit
# check of one batch lists and reads one bucket, not every log file.
LOG_BUCKETS = 64


def _bucket_of(batch_id: str) -> Column:
    return F.pmod(F.xxhash64(F.lit(batch_id)), F.lit(LOG_BUCKETS)).cast("int")


def read_run_log(spark: SparkSession, spec: TableSpec) -> DataFrame:
    return spark.read.schema(RUN_LOG_SCHEMA + ", bucket int").parquet(spec.run_log_path)


def write_log_row(spark: SparkSession, spec: TableSpec, row: DataFrame, batch_id: str) -> None:
    row.withColumn("bucket", _bucket_of(batch_id)).coalesce(1).write.mode("append").partitionBy("bucket").parquet(
        spec.run_log_path
    )


def committed(spark: SparkSession, spec: TableSpec, batch_id: str) -> bool:
    if not path_exists(spark, spec.run_log_path):
        return False
    log = read_run_log(spark, spec)
    hit = log.filter((F.col("bucket") == _bucket_value(spark, batch_id)) & (F.col("batch_id") == batch_id) & F.col("success"))
    return not hit.isEmpty()


def _bucket_value(spark: SparkSession, batch_id: str) -> int:
    return spark.range(1).select(_bucket_of(batch_id)).first()[0]  # a literal, so partitions are pruned


def _started_path(spec: TableSpec) -> str:
    return f"{spec.run_log_path.rstrip('/')}_started"


def mark_started(spark: SparkSession, spec: TableSpec, batch_id: str) -> bool:
    """Note that ``batch_id`` is about to write rows; True when an earlier attempt already was.

    Only then can the layers hold rows of it, so a first attempt reads neither.
    """
    path = _started_path(spec)
    if path_exists(spark, path):
        marks = spark.read.schema("batch_id string, bucket int").parquet(path)
        if not marks.filter((F.col("bucket") == _bucket_value(spark, batch_id)) & (F.col("batch_id") == batch_id)).isEmpty():
            return True
    mark = spark.range(1).select(F.lit(batch_id).alias("batch_id"), _bucket_of(batch_id).alias("bucket"))
    mark.coalesce(1).write.mode("append").partitionBy("bucket").parquet(path)
    return False


def run_batch(
    spark: SparkSession,
    raw: DataFrame,
    spec: TableSpec,
    rules: RuleSet,
    batch_id: str,
    mode: str = "evolve",
    row_id: list[str] | None = None,
    quarantine_text_columns: tuple[str, ...] | None = None,
    quarantine_ts: Column | None = None,
    timings: dict | None = None,
    on_incompatible: str = "evolve",
    log_failures: bool = True,
    unique_in_table: str | None = None,
) -> BatchOutcome:
    """Run one batch into the lake.

    ``on_incompatible`` (a change that is not backward compatible: a missing
    column or an unsafe type change): "evolve" (default) conforms and
    continues; "quarantine" sends the whole batch to quarantine with the
    reason ``schema_incompatible``; "fail" raises before anything is written.
    ``log_failures=False``: the caller records a failure itself.
    ``unique_in_table``: a key column; rows whose key the clean table already
    holds fail with ``<key>_exists_in_clean`` (UNIQUE alone looks inside the batch).
    """
    started = time.time()
    if quarantine_text_columns is None:
        quarantine_text_columns = spec.quarantine_text_columns
    mark = [time.perf_counter()]

    def step(name: str) -> None:
        if timings is not None:
            now = time.perf_counter()
            timings[name] = round(now - mark[0], 3)
            mark[0] = now

    if committed(spark, spec, batch_id):
        return BatchOutcome(batch_id, skipped=True)
    if raw.isEmpty():  # S7: no full count
        return BatchOutcome(batch_id, empty=True)

    registry = SchemaRegistry(spark, spec.registry_path)
    registered = None
    if spec.catalog_table:
        registered = catalog_schema(spark, spec.catalog_table)  # S12
    registered = registered or registry.get(spec.name) or spec.registered_schema
    columns = business_columns(raw)
    # metrics take NULL cells and copies from the flagged rows, so the raw batch is not read for them
    raw = raw.select("*", *profile_columns(raw, columns))
    prepared = prepare(raw, registered, rules, mode=mode, row_id=row_id)
    step("prepare")
    incompatible = not prepared.comparison.is_backward_compatible
    if incompatible and on_incompatible == "fail":
        error = SchemaDriftError(f"incompatible schema change: {[c.to_dict() for c in prepared.comparison.changes]}")
        if log_failures:
            log_failure(spark, spec, batch_id, started, error)
        raise error

    def flag(of: Validated) -> DataFrame:
        rows = of.flagged.withColumn(BATCH_ID, F.lit(batch_id))
        if unique_in_table and path_exists(spark, spec.clean_path):
            # rows of an earlier attempt at this batch are about to be removed
            others = read_layer(spark, spec).where(~F.col(BATCH_ID).eqNullSafe(batch_id))
            reason = F.array_union(F.col(FAILED), F.array(F.lit(f"{unique_in_table}_exists_in_clean")))
            rows = with_held(rows, others, unique_in_table, "_held_before").withColumns({VALID: F.col(VALID) & ~F.col("_held_before"), FAILED: F.when(F.col("_held_before"), reason).otherwise(F.col(FAILED))}).drop("_held_before")
        if incompatible and on_incompatible == "quarantine":
            rows = rows.withColumns({VALID: F.lit(False), FAILED: F.array_union(F.col(FAILED), F.array(F.lit(SCHEMA_INCOMPATIBLE)))})
        return rows.persist(StorageLevel.MEMORY_AND_DISK)

    checked = prepared.validated
    cached: list[DataFrame] = [flag(checked)]
    try:
        try:
            cached[0].count()  # every rule is evaluated once, here
        except Exception:
            # A rule that fails as it runs is left out and reported, the others go on
            errors = failing_rules(prepared.conformed, checked.applied)
            if not errors:
                raise
            cached.pop().unpersist()
            checked = validate(prepared.conformed, rules, row_id=row_id, known_errors=errors)
            cached.append(flag(checked))
        flagged = cached[0]
        validated = Validated(flagged, checked.rules, checked.applied, checked.rule_errors)
        step("flag")
        if mark_started(spark, spec, batch_id):
            for path in (spec.clean_path, spec.quarantine_path):
                remove_batch(spark, path, batch_id, spec.partition_by)
        step("remove_half_written")

        clean = with_partitions(validated.valid.drop(RESCUED, ROW_PRINT, NULL_CELLS), spec.date_column)
        quarantine = with_partitions(
            to_quarantine(validated.invalid.drop(ROW_PRINT, NULL_CELLS), quarantine_ts, quarantine_text_columns), spec.date_column
        )
        write_partitioned(clean, spec.clean_path, spec.partition_by)
        step("write_clean")

        metrics = collect_metrics(
            flagged, validated, spec.name, [c.to_dict() for c in prepared.comparison.changes], columns
        ).persist()
        cached.append(metrics)
        m = metrics.select("total_records", "valid_records", "invalid_records", "duplicate_records", "data_quality_score").first().asDict()
        step("metrics")
        if m["invalid_records"] > 0:  # S10: skipped when nothing failed
            write_partitioned(quarantine, spec.quarantine_path, spec.partition_by)
        step("write_quarantine")

        alerts = check_thresholds(metrics, spec.thresholds).persist()
        cached.append(alerts)
        write_rows(metrics, spec.metrics_path, "json", batch_id)
        alert_rows = [r.asDict() for r in alerts.collect()]  # at most three
        if alert_rows:
            write_rows(alerts, spec.alerts_path, "parquet", batch_id)

        publish = prepared.comparison.is_new_table or (mode == "evolve" and prepared.comparison.has_changes)
        if publish and not (incompatible and on_incompatible == "quarantine"):
            evolved = evolved_schema(prepared.comparison, mode)
            registry.publish(spec.name, evolved, batch_id)  # E8 / a new table registers version 1
            if spec.catalog_table and spark.catalog.tableExists(spec.catalog_table) and registered is not None:
                known = {f.name.lower() for f in registered.fields}
                added = StructType([f for f in evolved.fields if f.name.lower() not in known])
                add_catalog_columns(spark, spec.catalog_table, added)  # S13

        duration = time.time() - started
        log_success(
            spark, spec, batch_id, started, m["total_records"], m["valid_records"], m["invalid_records"], m["data_quality_score"], len(prepared.comparison.changes), len(alert_rows)
        )
        step("logs_registry_runlog")
        return BatchOutcome(batch_id, comparison=prepared.comparison, metrics=m, alerts=alert_rows, duration_sec=duration)
    except Exception as exc:
        # A failed batch leaves a failure row (not a commit marker) and re-raises.
        if log_failures:
            log_failure(spark, spec, batch_id, started, exc)
        raise
    finally:
        for df in cached:
            df.unpersist()


def log_success(spark: SparkSession, spec: TableSpec, batch_id: str, started: float, total: int, valid: int, invalid: int, score: float | None = None, changes: int = 0, alerts: int = 0) -> None:
    """The commit marker of a batch, written last."""
    row = (spec.name, batch_id, True, None, time.time() - started, total, valid, invalid, score, changes, alerts, None)
    log_row = spark.createDataFrame([row], RUN_LOG_SCHEMA).withColumn("started_at", F.lit(started).cast("timestamp"))
    write_log_row(spark, spec, log_row, batch_id)


def log_failure(spark: SparkSession, spec: TableSpec, batch_id: str, started: float, exc: BaseException) -> None:
    fail_row = spark.createDataFrame(
        [(spec.name, batch_id, False, None, time.time() - started, None, None, None, None, None, None, str(exc))],
        RUN_LOG_SCHEMA,
    ).withColumn("started_at", F.lit(started).cast("timestamp"))
    write_log_row(spark, spec, fail_row, batch_id)


def run_summary(spark: SparkSession, spec: TableSpec) -> DataFrame:
    """Per table, batches succeeded and failed, rows and average score."""
    log = read_run_log(spark, spec)
    return log.groupBy("table_name").agg(
        F.count_if(F.col("success")).alias("succeeded"),
        F.count_if(~F.col("success")).alias("failed"),
        F.sum("total_records").alias("total_records"),
        F.sum("valid_records").alias("valid_records"),
        F.sum("invalid_records").alias("invalid_records"),
        F.avg("data_quality_score").alias("avg_quality_score"),
    )


def read_layer(spark: SparkSession, spec: TableSpec, layer: str = "clean") -> DataFrame:
    """Read a layer with the newest registered schema.

    Files written before a column was added show NULL for it.  The schema
    comes from the registry, so no job has to open every file footer (what
    ``mergeSchema`` would do at scale)."""
    from pyspark.sql.types import IntegerType, MapType, ArrayType, StringType, StructField, StructType, TimestampType

    registered = SchemaRegistry(spark, spec.registry_path).get(spec.name) or spec.registered_schema
    fields = list(registered.fields) if registered is not None else []
    extra = [StructField(BATCH_ID, StringType())]
    if layer == "quarantine":
        text = set(spec.quarantine_text_columns)
        fields = [StructField(f.name, StringType()) if f.name in text else f for f in fields]
        extra += [
            StructField("quarantine_timestamp", TimestampType()),
            StructField("_failed_rules", ArrayType(StringType())),
            StructField("_rescued", MapType(StringType(), StringType())),
        ]
    parts = [StructField(c, IntegerType()) for c in spec.partition_by]
    path = spec.clean_path if layer == "clean" else spec.quarantine_path
    return spark.read.schema(StructType(fields + extra + parts)).parquet(path)
