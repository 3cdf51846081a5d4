"""Lake sinks.

Clean and quarantine rows are appended as Parquet partitioned by
year/month/day.  Rows are first range-partitioned on (year, month, day,
row hash): the sampled range bounds put each small day in one task (one
file per day, written in order) and cut a large day into several hash
ranges, so no single task writes a hot day and no task opens a file for
every day.  Every row carries ``_batch_id`` so a batch can be
found and removed again (idempotent retries, see ``remove_batch``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lineage import BATCH_ID



def with_partitions(df: DataFrame, date_column: str | None = "order_date", now: Column | None = None) -> DataFrame:
    """year/month/day from the date column (try_cast, so text that is no
    date gives NULL -> the default partition), else from the run time."""
    if date_column and date_column in df.columns:
        d = F.col(f"`{date_column}`").try_cast("date")
    else:
        d = (now if now is not None else F.current_timestamp()).cast("date")
    return df.withColumns({"year": F.year(d), "month": F.month(d), "day": F.dayofmonth(d)})


def _hashable(dt) -> bool:
    from pyspark.sql.types import ArrayType, MapType, StructType

    if isinstance(dt, MapType):
        return False
    if isinstance(dt, ArrayType):
        return _hashable(dt.elementType)
    if isinstance(dt, StructType):
        return all(_hashable(f.dataType) for f in dt.fields)
    return True


def _spread(df: DataFrame, partition_by: list[str]) -> DataFrame:
    cols = [F.col(f"`{f.name}`") for f in df.schema.fields if f.name not in partition_by and _hashable(f.dataType)]
    salt = F.xxhash64(*cols) if cols else F.lit(0)
    return df.repartitionByRange(*[F.col(c) for c in partition_by], salt)


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: list[str] | tuple[str, ...] = ("year", "month", "day"),
    mode: str = "append",
) -> None:
    """Parquet (Snappy), partitioned, appended; range-partitioned first, whatever days the batch covers."""
    parts = list(partition_by)
    (
        _spread(df, parts)
        .write.mode(mode)
        .option("compression", "snappy")
        .partitionBy(*parts)
        .parquet(path)
    )


def to_quarantine(
    invalid: DataFrame,
    timestamp: Column | None = None,
    text_columns: list[str] | tuple[str, ...] = (),
    rescued_col: str = "_rescued",
) -> DataFrame:
    """S10 row shape: ``quarantine_timestamp``; columns listed in
    ``text_columns`` are stored as the original text (a value the typed cast
    rejected is taken back from ``_rescued``)."""
    out = invalid.withColumn("quarantine_timestamp", timestamp if timestamp is not None else F.current_timestamp())
    for c in text_columns:
        if c not in out.columns:
            continue
        typed = F.col(f"`{c}`").cast("string")
        if rescued_col in out.columns:
            typed = F.coalesce(typed, F.col(rescued_col)[c])
        out = out.withColumn(c, typed)
    return out


def write_rows(df: DataFrame, path: str, fmt: str = "parquet", batch_id: str | None = None) -> None:
    """S11 / logs: append small log rows (metrics, alerts).

    With ``batch_id`` the rows are that batch's, in a partition of its own: a
    retried batch replaces them, so they are never doubled."""
    if batch_id is None:
        df.coalesce(1).write.mode("append").format(fmt).save(path)
        return
    key = F.concat(F.lit("b"), F.hex(F.xxhash64(F.lit(batch_id))))
    rows = df.withColumns({"batch_id": F.lit(batch_id), "batch_key": key})
    rows.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_key").format(fmt).save(path)


def compact_log(
    spark,
    path: str,
    fmt: str = "parquet",
    files: int = 1,
    partition_by: tuple[str, ...] = (),
    keep_since: tuple[str, object] | None = None,
) -> None:
    """Rewrite an append-only log (one small file per batch) into a few files.

    ``keep_since=(timestamp_column, cutoff)`` also applies retention (S22:
    e.g. logs older than 180 days are dropped).  The kept rows are
    checkpointed to ``spark.checkpoint.dir`` first, so the overwrite never
    reads the files it replaces."""
    from ..session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    reader = spark.read.format(fmt)
    if fmt == "parquet":
        reader = reader.option("mergeSchema", "true")
    rows = reader.load(path)
    if keep_since is not None:
        column, cutoff = keep_since
        rows = rows.filter(F.col(column).cast("timestamp") >= F.lit(cutoff).cast("timestamp"))
    rows = rows.checkpoint(eager=True)
    writer = rows.repartition(files, *partition_by) if partition_by else rows.repartition(files)
    writer = writer.write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def path_exists(spark, path: str) -> bool:
    """Whether there is anything at ``path``; a storage error raises."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def delete(spark, path: str) -> None:
    """Delete what is at ``path``, if there is anything."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def rewrite_partitions(spark, path: str, keep: DataFrame, touched: list, partition_by=("year", "month", "day")) -> None:
    """Replace the ``touched`` partitions of ``path`` with the rows of ``keep``.

    ``keep`` must not depend on the files being replaced (checkpoint it
    first).  Partitions with rows in ``keep`` are overwritten (dynamic
    partition overwrite); touched partitions left without rows are deleted.
    ``touched`` is a list of partition value tuples -- one per day, small.
    """
    parts = list(partition_by)
    kept = {tuple(r) for r in keep.select(*parts).distinct().collect()}
    (
        keep.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts)
        .parquet(path)
    )
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for values in touched:
        if tuple(values) in kept:
            continue
        sub = "/".join(
            f"{c}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for c, v in zip(parts, values)
        )
        p = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{sub}")
        p.getFileSystem(conf).delete(p, True)


def remove_batch(spark, path: str, batch_id: str, partition_by: list[str] | tuple[str, ...] = ("year", "month", "day")) -> None:
    """Drop the rows of one half-written batch.

    Only the partitions the batch touched are rewritten, with everybody
    else's rows; the kept rows are checkpointed first, so the overwrite never
    reads the files it replaces.
    """
    if not path_exists(spark, path):
        return  # nothing written yet; any error while reading what exists raises
    # mergeSchema: files written before a column was added must keep the
    # newer columns when rewritten (types never diverge: every write is
    # conformed to the registry first).
    table = spark.read.option("mergeSchema", "true").parquet(path)
    if BATCH_ID not in table.columns:
        return
    parts = list(partition_by)
    mine = table.filter(F.col(BATCH_ID) == batch_id)
    if mine.isEmpty():
        return
    touched = [tuple(r) for r in mine.select(*parts).distinct().collect()]
    # Null-safe on the partition values: the default partition (NULL) matches too.
    t = mine.select(*[F.col(c).alias(f"_t_{c}") for c in parts]).distinct()
    cond = [table[c].eqNullSafe(t[f"_t_{c}"]) for c in parts]
    in_touched = table.join(t, cond, "left_semi")
    from ..session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    # null-safe: rows without a batch id belong to no failed batch and stay
    keep = in_touched.filter(~F.col(BATCH_ID).eqNullSafe(batch_id)).checkpoint(eager=True)
    rewrite_partitions(spark, path, keep, touched, parts)
