"""Spark session helpers.

The library never creates a session behind the caller's back: every public
function takes an existing ``SparkSession`` or a DataFrame.  ``local_session``
exists for tests, the bench and the driver entry point.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session of ours relies on.  ANSI mode stays on (Spark 4
# default); the library uses ``try_cast`` wherever bad input is expected.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "driftgate") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in BASE_CONF.items():
        builder = builder.config(key, value)
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("DRIFTGATE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Partitioned writes are bound by the number of files, not bytes, when
        # every day holds little data: keep enough tasks writing in parallel.
        # On a cluster the advisory partition size governs.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256k")
        # Local disk only: no ".crc" sidecar per file (a cluster writes to a
        # distributed file system or object store, which has no such files).
        .config("spark.hadoop.fs.file.impl", "org.apache.hadoop.fs.RawLocalFileSystem")
        .config("spark.hadoop.fs.file.impl.disable.cache", "true")
    )
    event_log = os.environ.get("DRIFTGATE_EVENT_LOG")  # a scratch folder, for stage/task times
    if event_log:
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting names a shared file system folder and is used as
    is.  Only when it is unset (tests, a laptop) do we pick a scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder; a machine-local one cannot survive executor loss")
        configured = tempfile.mkdtemp(prefix="driftgate-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()
