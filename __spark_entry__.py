"""

``entry(spark)`` runs the flagship slice on sf0.001: raw orders -> conform to
the registered schema -> the six orders rules (first-occurrence UNIQUE
included) -> the valid rows -> revenue by region.

``queries()`` registers every operator/query that reads the driver tables;
``oracle_sql()`` gives the DuckDB twin of each one that SQL can state.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

# importable from any working directory (the package sits next to this file)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.types import StructType  # noqa: E402

from driftgate.operators.alerts import check_thresholds, digest  # noqa: E402
from driftgate.operators.evolve import conform, evolve  # noqa: E402
from driftgate.operators.metrics import collect_metrics, duplicate_count, metrics_json, null_counts, numeric_summary  # noqa: E402
from driftgate.operators.rules import INFO, WARNING, Rule, RuleSet  # noqa: E402
from driftgate.operators.schema_diff import (  # noqa: E402
    batch_compatibility,
    detect,
    diff_batches,
    infer_batch_types,
    infer_cell_types,
)
from driftgate.operators.uniqueness import with_held  # noqa: E402
from driftgate.operators.validate import FAILED, VALID, validate  # noqa: E402
from driftgate.plans import analytics as A  # noqa: E402
from driftgate.plans import orders as O  # noqa: E402
from driftgate.plans.oracle_sql import ORACLE  # noqa: E402
from driftgate.sources.admission import parse_events  # noqa: E402
from driftgate.session import ensure_checkpoint_dir  # noqa: E402
from driftgate.sources import driver_tables as dt  # noqa: E402
from driftgate.sources.headers import file_types  # noqa: E402

# The training-data operators live in one optional subpackage; without it the
# rest of the library and its queries work as they are.
try:
    import driftgate.llm.queries as _llm
except ImportError:
    _llm = None
try:
    import corpus_pipeline as _pipeline
except ImportError:
    _pipeline = None

#: queries that write the files they read, and so run jobs when they are built
LANDING = {"landed_drift", "landed_compatibility"}

FLAGSHIP_SF = "/root/testdata/sf0.001"


def _money_out(df: DataFrame) -> DataFrame:
    return df.withColumn("price", F.col("price").cast("double"))


def _validated_rows(spark: SparkSession, sf: str) -> DataFrame:
    p = O.raw_pipeline(spark, sf)
    return _money_out(p.valid.select(*[f.name for f in O.ORDERS_SCHEMA.fields]))


def _quarantined_rows(spark: SparkSession, sf: str) -> DataFrame:
    q = O.quarantine_orders(O.raw_pipeline(spark, sf))
    return _money_out(
        q.select(
            *[f.name for f in O.ORDERS_SCHEMA.fields],
            "quarantine_timestamp",
            F.concat_ws(",", F.col(FAILED)).alias("failed_rules"),
        )
    )


def _rule_results(spark: SparkSession, sf: str) -> DataFrame:
    return O.raw_pipeline(spark, sf).validated.results().drop("error_message")


_METRIC_COLS = ["total_records", "valid_records", "invalid_records", "duplicate_records", "total_null_cells", "data_quality_score"]


def _metrics(spark: SparkSession, sf: str) -> DataFrame:
    p = O.raw_pipeline(spark, sf)
    raw = dt.raw_orders(spark, sf)
    return collect_metrics(raw, p.validated, "orders", [c.to_dict() for c in p.comparison.changes])


def _quality_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return _metrics(spark, sf).select(*_METRIC_COLS)


def _quality_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return check_thresholds(_metrics(spark, sf)).select("alert_type", "severity", "metric_value", "threshold_value")


def _null_counts(spark: SparkSession, sf: str) -> DataFrame:
    raw = dt.raw_orders(spark, sf)
    return null_counts(raw)


def _rescued_values(spark: SparkSession, sf: str) -> DataFrame:
    c = O.raw_pipeline(spark, sf).conformed
    return (
        c.select(F.explode("_rescued").alias("column_name", "raw_value"))
        .groupBy("column_name", "raw_value")
        .agg(F.count(F.lit(1)).alias("cells"))
    )


def _batch_types(spark: SparkSession, sf: str) -> DataFrame:
    """Every column of every daily batch as text (a CSV read without inference)."""
    raw = dt.raw_orders(spark, sf)
    cols = [f.name for f in O.ORDERS_SCHEMA.fields]
    text = raw.select(F.col("_ingest_ts").cast("date").alias("batch"), *[F.col(c).cast("string").alias(c) for c in cols])
    return infer_batch_types(text, "batch")


def _schema_drift_by_batch(spark: SparkSession, sf: str) -> DataFrame:
    return diff_batches(_batch_types(spark, sf), O.ORDERS_SCHEMA)


def _batch_compatibility(spark: SparkSession, sf: str) -> DataFrame:
    return batch_compatibility(_batch_types(spark, sf), O.ORDERS_SCHEMA)


def _feed_types(spark: SparkSession, sf: str) -> tuple[DataFrame, StructType]:
    return infer_cell_types(dt.feed_cells(spark, sf)), StructType.fromDDL(dt.FEED_SCHEMA)


def _feed_drift(spark: SparkSession, sf: str) -> DataFrame:
    """D1-D4 over daily files whose headers differ."""
    return diff_batches(*_feed_types(spark, sf))


def _feed_compatibility(spark: SparkSession, sf: str) -> DataFrame:
    """D5/D6 over the same files: safe and unsafe changes both occur."""
    return batch_compatibility(*_feed_types(spark, sf))


def _landed(spark: SparkSession, sf: str) -> DataFrame:
    """The types of every landed file's own columns: CSV files written from orders, read back by their headers, then dropped."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/landed-{uuid.uuid4().hex}"
    dt.land_feed(spark, sf, path)
    types = file_types(spark, f"{path}/*/*/*.csv", width=8)
    month = F.regexp_extract("batch", "batch=([0-9-]+)", 1)
    kept = types.withColumn("batch", month).distinct().checkpoint()
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
    return kept


def _landed_drift(spark: SparkSession, sf: str) -> DataFrame:
    """D1-D4 over landed CSV files with different headers."""
    return diff_batches(_landed(spark, sf), StructType.fromDDL(dt.FEED_SCHEMA))


def _landed_compatibility(spark: SparkSession, sf: str) -> DataFrame:
    """D5/D6 over the same files."""
    return batch_compatibility(_landed(spark, sf), StructType.fromDDL(dt.FEED_SCHEMA))


def _validation_balance(spark: SparkSession, sf: str) -> DataFrame:
    """V2/V8 where a third of the order values is NULL: valid + invalid is every row."""
    seen = F.when(F.col("_l_partkey") % 3 != 0, F.col("_ingest_ts"))
    raw = dt.raw_orders(spark, sf).withColumn("_seen", seen)
    rules = RuleSet((Rule.unique("customer_id", order_by=["_seen", *dt.LINE_ORDER, "_ingest_ts", "order_id"]), Rule.range("quantity", min=1)))
    return validate(raw, rules, row_id=[]).flagged.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(VALID)).alias("valid"),
        F.count_if(~F.col(VALID)).alias("invalid"),
    )


def _rule_types(spark: SparkSession, sf: str) -> DataFrame:
    """Type, pattern, custom and unanswerable rules of every severity."""
    rules = RuleSet(
        (
            Rule.datatype("order_date", "date", severity=WARNING),
            Rule.pattern("order_id", "^[0-9]+-[1-3]$", severity=INFO),
            Rule.expr("price_below_1500", "price < 1500"),
            Rule.not_null("coupon"),
        )
    )
    return validate(dt.raw_orders(spark, sf), rules, row_id=[]).results().drop("error_message")


def _cross_batch_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Uniqueness across batches: the last year's orders by whether their customer ordered before."""
    orders = dt.table(spark, sf, "orders").select(F.col("o_custkey").alias("key"), F.year("o_orderdate").alias("year"))
    last = F.lit(O.AS_OF.year)
    flagged = with_held(orders.where(F.col("year") == last), orders.where(F.col("year") < last), "key", "held", bits=1 << 24)
    return flagged.groupBy("held").agg(F.count(F.lit(1)).alias("orders"), F.count_distinct("key").alias("customers"))


def _defective_metrics(spark: SparkSession, sf: str) -> DataFrame:
    raw = dt.defective_orders(spark, sf)
    rules = RuleSet((Rule.not_null("customer_id"), Rule.range("price", min=0), Rule.not_null("priority", severity=WARNING)))
    return collect_metrics(raw, validate(raw, rules), "orders", execution_ts=F.lit(str(O.AS_OF)).cast("timestamp"))


def _defective_counts(spark: SparkSession, sf: str) -> DataFrame:
    """M1-M5 where copies, NULLs, failing and warned rows all occur."""
    nulls = F.col("null_counts")
    return _defective_metrics(spark, sf).select(*_METRIC_COLS, nulls["customer_id"].alias("null_customer_id"), nulls["priority"].alias("null_priority"))


def _defective_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """M6: every alert fires."""
    return check_thresholds(_defective_metrics(spark, sf)).select("alert_type", "severity", "metric_value", "threshold_value")


def _defective_digest(spark: SparkSession, sf: str) -> DataFrame:
    """M7: the digest of these alerts."""
    return digest(check_thresholds(_defective_metrics(spark, sf))).select("table_name", "subject", "body")


def _defective_document(spark: SparkSession, sf: str) -> DataFrame:
    """M8, M9: the metrics document, read back: its schema section and one row per rule."""
    rule = "struct<rule_name: string, failed_count: long, total_count: long, severity: string>"
    fields = f"table_name string, schema_info struct<columns: array<string>, column_count: int>, validation_results array<{rule}>"
    doc = metrics_json(_defective_metrics(spark, sf)).select(F.from_json("json", fields).alias("d"))
    about = doc.select(
        F.col("d.table_name").alias("table_name"),
        F.array_join("d.schema_info.columns", ",").alias("columns"),
        F.col("d.schema_info.column_count").cast("long").alias("column_count"),
        F.explode("d.validation_results").alias("r"),
    )
    return about.select("table_name", "columns", "column_count", "r.*")


def _evolved(spark: SparkSession, sf: str, mode: str) -> DataFrame:
    incoming = dt.incoming_orders(spark, sf)
    registered = StructType.fromDDL(dt.FEED_SCHEMA)
    rows = evolve(incoming, detect(incoming.schema, registered), mode=mode, rescue=True)
    kept = F.col("_rescued")
    return rows.select(*[c for c in rows.columns if c != "_rescued"], kept["total"].alias("lost_total"), kept["customer_id"].alias("lost_customer_id"))


def _evolved_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Registered order, the missing column as NULL, casts with the lost originals, the new column after them."""
    return _evolved(spark, sf, "evolve")


def _matched_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The registered columns alone."""
    return _evolved(spark, sf, "match")


def _admitted_files(spark: SparkSession, sf: str) -> DataFrame:
    """The objects to admit, from arrival events."""
    return parse_events(dt.arrival_events(spark, sf), "event", "raw/orders/")


def _quality_summary(spark: SparkSession, sf: str) -> DataFrame:
    p = O.raw_pipeline(spark, sf)
    return A.quality_summary(p.valid, O.quarantine_orders(p))


def _conformed_rows(spark: SparkSession, sf: str) -> DataFrame:
    """E4-E7 'match': the raw batch cast onto the registered schema, new columns dropped."""
    typed = conform(dt.raw_orders(spark, sf), O.ORDERS_SCHEMA, keep_new=False)
    return _money_out(typed.drop("_ingest_ts", *dt.LINE_ORDER))


def _duplicate_rows(spark: SparkSession, sf: str) -> DataFrame:
    return duplicate_count(dt.raw_orders(spark, sf))


def _numeric_summary(spark: SparkSession, sf: str) -> DataFrame:
    summary = numeric_summary(O.clean_orders(spark, sf), ["quantity", "price"])
    return summary.withColumns({c: F.round(c, 6) for c in ("mean", "stddev")})  # sums of doubles differ by their order


def _clean(fn: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf: fn(O.clean_orders(spark, sf))


def _quar(fn: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf: fn(O.quarantine_orders(O.raw_pipeline(spark, sf)))


def entry(spark: SparkSession) -> DataFrame:
    valid = O.raw_pipeline(spark, FLAGSHIP_SF).valid
    return A.revenue_by_region(valid)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = dict(_reference_queries())
    if _llm is not None:
        named |= _llm.QUERIES
    if _llm is not None and _pipeline is not None:
        named["pipeline"] = _pipeline.run
    return named


def _reference_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        # pipeline operators over raw_orders (D, E, V, M)
        "validated_rows": _validated_rows,
        "quarantined_rows": _quarantined_rows,
        "rule_results": _rule_results,
        "quality_metrics": _quality_metrics,
        "null_counts": _null_counts,
        "quality_alerts": _quality_alerts,
        "rescued_values": _rescued_values,
        "schema_drift_by_batch": _schema_drift_by_batch,
        "batch_compatibility": _batch_compatibility,
        "feed_drift": _feed_drift,
        "feed_compatibility": _feed_compatibility,
        "landed_drift": _landed_drift,
        "landed_compatibility": _landed_compatibility,
        "validation_balance": _validation_balance,
        "rule_types": _rule_types,
        "cross_batch_keys": _cross_batch_keys,
        "defective_counts": _defective_counts,
        "defective_alerts": _defective_alerts,
        "defective_digest": _defective_digest,
        "defective_document": _defective_document,
        "evolved_rows": _evolved_rows,
        "matched_rows": _matched_rows,
        "admitted_files": _admitted_files,
        "conformed_rows": _conformed_rows,
        "duplicate_rows": _duplicate_rows,
        "numeric_summary": _numeric_summary,
        # the query book (Q1-Q21)
        "clean_count": _clean(A.clean_count),
        "count_by_day": _clean(A.count_by_day),
        "quarantine_count": _quar(A.quarantine_count),
        "quality_summary": _quality_summary,
        "null_check": _clean(A.null_check),
        "duplicate_ids": _clean(A.duplicate_ids),
        "revenue_by_day": _clean(A.revenue_by_day),
        "revenue_by_region": _clean(A.revenue_by_region),
        "top_products": _clean(A.top_products),
        "status_share": _clean(A.status_share),
        "daily_trend_30d": _clean(lambda df: A.daily_trend_30d(df, O.AS_OF)),
        "repeat_customers": _clean(A.repeat_customers),
        "revenue_by_shipping": _clean(A.revenue_by_shipping),
        "column_population": _clean(A.column_population),
        "monthly_revenue": _clean(A.monthly_revenue),
        "week_over_week": _clean(A.week_over_week),
        "quarantine_by_date": _quar(A.quarantine_by_date),
        "quarantine_issues": _quar(A.quarantine_issues),
        "partition_share": _clean(A.partition_share),
        "stale_partitions": _clean(lambda df: A.stale_partitions(df, O.AS_OF)),
        "customer_segments": _clean(lambda df: A.customer_segments(df, O.AS_OF)),
        "product_affinity": _clean(A.product_affinity),
        "daily_sales_summary": _clean(A.daily_sales_summary),
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB twins of the registered queries that SQL can state."""
    named = dict(ORACLE)
    if _llm is not None:
        named |= _llm.ORACLE
    if _llm is not None and _pipeline is not None and _pipeline.ORACLE_SQL:
        named["pipeline"] = _pipeline.ORACLE_SQL
    return named
