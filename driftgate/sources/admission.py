"""File admission and arrival events.

Both are column expressions, so a listing or an event log of any size is
filtered by Spark: ``admitted`` is one Boolean ``Column`` over (key, size);
``parse_events`` turns a DataFrame of event documents into one row per
admitted object.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Admitted extensions, the event source tag, and the event layout.
EXTENSIONS = (".csv", ".json", ".parquet")
EVENT_SOURCE = "aws:s3"
EVENT_SCHEMA = (
    "Records array<struct<eventSource:string, eventTime:string, "
    "s3:struct<bucket:struct<name:string>, object:struct<key:string, size:bigint>>>>"
)


def admitted(key: Column, size: Column, prefix: str) -> Column:
    """S3: under ``prefix``; extension in csv/json/parquet (any case); non-empty;
    base name not starting with '.' or '_'."""
    name = F.element_at(F.split(key, "/"), -1)
    ext_ok = F.lit(False)
    for ext in EXTENSIONS:
        ext_ok = ext_ok | F.lower(key).endswith(ext)
    return F.coalesce(
        key.startswith(prefix)
        & ext_ok
        & (size > 0)
        & ~name.startswith(".")
        & ~name.startswith("_"),
        F.lit(False),
    )


def parse_events(events: DataFrame, json_col: str, prefix: str) -> DataFrame:
    """Event JSON -> (bucket, key, size, event_time) for admitted objects.

    Keys arrive URL-encoded with '+' for spaces; ``try_url_decode`` decodes
    both, and a malformed escape yields NULL (then not admitted) instead of
    failing the job.
    """
    parsed = events.select(F.from_json(F.col(json_col), EVENT_SCHEMA).alias("e"))
    recs = parsed.select(F.explode_outer("e.Records").alias("r")).filter(F.col("r.eventSource") == EVENT_SOURCE)
    rows = recs.select(
        F.col("r.s3.bucket.name").alias("bucket"),
        F.try_url_decode(F.col("r.s3.object.key")).alias("key"),
        F.col("r.s3.object.size").alias("size"),
        F.coalesce(F.col("r.eventTime"), F.lit("")).alias("event_time"),
    )
    return rows.filter(admitted(F.col("key"), F.col("size"), prefix))
