"""Threshold alerts and digest (M6, M7).

Alerts are derived from the metrics row with column expressions:
``explode(array_compact(array(when(breach, alert)...)))``.  Percentages are
only checked on a non-empty batch; comparisons are strict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..settings import Thresholds

ALERT_SCHEMA = "alert_type string, severity string, message string, metric_value double, threshold_value double, timestamp timestamp"

# Alert type names and message texts ({threshold} is filled in
# from Thresholds, %.2f / %s by Spark from the metric), and the digest subject.
INVALID_RECORDS = "INVALID_RECORDS_THRESHOLD_EXCEEDED"
DUPLICATE_RECORDS = "DUPLICATE_RECORDS_THRESHOLD_EXCEEDED"
LOW_SCORE = "LOW_QUALITY_SCORE"
INVALID_MESSAGE = "Invalid records percentage (%.2f%%) exceeds threshold ({threshold}%%)"
DUPLICATE_MESSAGE = "Duplicate records percentage (%.2f%%) exceeds threshold ({threshold}%%)"
LOW_SCORE_MESSAGE = "Data quality score (%s) is below threshold ({threshold})"
DIGEST_SUBJECT = "Data Quality Alert - %d Errors, %d Warnings"
DIGEST_HEADER = "Data Quality Alerts:\n\n"


def _pct(part: Column, total: Column) -> Column:
    return part.cast("double") / total.cast("double") * 100.0


def _alert(kind: str, severity: str, message: Column, value: Column, threshold: float, ts: Column) -> Column:
    return F.struct(
        F.lit(kind).alias("alert_type"),
        F.lit(severity).alias("severity"),
        message.alias("message"),
        value.cast("double").alias("metric_value"),
        F.lit(float(threshold)).alias("threshold_value"),
        ts.alias("timestamp"),
    )


def alert_structs(metrics: DataFrame, thresholds: Thresholds = Thresholds(), ts: Column | None = None) -> Column:
    total = F.col("total_records")
    ts = ts if ts is not None else F.col("execution_timestamp")
    invalid_pct = _pct(F.col("invalid_records"), total)
    dup_pct = _pct(F.col("duplicate_records"), total)
    score = F.col("data_quality_score")
    t = thresholds
    invalid = _alert(
        INVALID_RECORDS,
        "ERROR",
        F.format_string(INVALID_MESSAGE.format(threshold=t.max_invalid_percentage), invalid_pct),
        invalid_pct,
        t.max_invalid_percentage,
        ts,
    )
    dup = _alert(
        DUPLICATE_RECORDS,
        "WARNING",
        F.format_string(DUPLICATE_MESSAGE.format(threshold=t.max_duplicate_percentage), dup_pct),
        dup_pct,
        t.max_duplicate_percentage,
        ts,
    )
    low = _alert(
        LOW_SCORE,
        "ERROR",
        F.format_string(LOW_SCORE_MESSAGE.format(threshold=t.min_quality_score), score.cast("string")),
        score,
        t.min_quality_score,
        ts,
    )
    return F.array_compact(
        F.array(
            F.when((total > 0) & (invalid_pct > t.max_invalid_percentage), invalid),
            F.when((total > 0) & (dup_pct > t.max_duplicate_percentage), dup),
            F.when(score < t.min_quality_score, low),
        )
    )


def check_thresholds(metrics: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """M6: one row per alert, carrying the table name of the metrics row."""
    return metrics.select(F.col("table_name"), F.inline(alert_structs(metrics, thresholds)))


def _check_order() -> Column:
    return (
        F.when(F.col("alert_type") == INVALID_RECORDS, 0)
        .when(F.col("alert_type") == DUPLICATE_RECORDS, 1)
        .when(F.col("alert_type") == LOW_SCORE, 2)
        .otherwise(3)
    )


def digest(alerts: DataFrame) -> DataFrame:
    """M7: per run (table, timestamp): subject with ERROR/WARNING counts and one
    text block per alert.  A run raises at most three alerts, so each group is
    bounded."""
    block = F.concat_ws(
        "\n",
        F.concat(F.lit("["), F.col("severity"), F.lit("] "), F.col("alert_type")),
        F.concat(F.lit("  "), F.col("message")),
        F.concat(F.lit("  Timestamp: "), F.col("timestamp").cast("string")),
    )
    return alerts.groupBy("table_name", "timestamp").agg(
        F.format_string(
            DIGEST_SUBJECT,
            F.count_if(F.col("severity") == "ERROR"),
            F.count_if(F.col("severity") == "WARNING"),
        ).alias("subject"),
        F.concat(
            F.lit(DIGEST_HEADER),
            # blocks in the order the checks run: invalid share, duplicates, score
            F.concat_ws("\n\n", F.sort_array(F.collect_list(F.struct(_check_order().alias("o"), block.alias("b")))).getField("b")),
        ).alias("body"),
    )
