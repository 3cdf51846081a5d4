"""Where operators keep intermediate tables: the shared folder of the session."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from driftgate.session import ensure_checkpoint_dir


def stash(df: DataFrame) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir``, return it reread and its folder.

    A lost executor then costs a reread, never a recomputation of the chain
    that made the table.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stash-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop(spark: SparkSession, path: str) -> None:
    """Delete a stash that no later plan reads."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """An eager reliable checkpoint in the shared folder (removed with its last reference when the session says so)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package: by PYTHONPATH where it is set, else as a zip that Spark distributes."""
    sc = spark.sparkContext
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    if root in os.environ.get("PYTHONPATH", "").split(os.pathsep) or getattr(sc, "_driftgate_shipped", False):
        return
    base = os.path.join(tempfile.mkdtemp(prefix="driftgate-zip-"), "driftgate")
    sc.addPyFile(shutil.make_archive(base, "zip", root, "driftgate"))
    sc._driftgate_shipped = True
