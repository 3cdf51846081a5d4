"""Incremental file ingest (S5, S6) with Structured Streaming.

The stream discovers files; each file is then read as the batch job reads
it.  A file source with one fixed schema maps CSV columns by position, so a
file whose columns were reordered, added or dropped -- the drift this
library exists to catch -- would be misread.  Instead the ``binaryFile``
source lists new files under the raw prefix (only path and length are
selected, so file contents are not read by the stream), the admission rule
(S3: extension, non-empty, not hidden) is applied as a column, and inside
``foreachBatch`` the admitted CSV files of a trigger are grouped by their headers
(``sources.headers``, one job).  Each group is read and run as one batch, so a
trigger of a hundred files makes one plan per header, not one per file; other
formats go file by file.  ``maxFilesPerTrigger`` bounds the file list of a
micro-batch (the only thing collected).

Exactly once: the streaming checkpoint (under the lake's logs folder, a
shared path) records which files were listed; a batch id names its files, and
the run log makes a re-delivered group a no-op, so a restart neither skips nor
doubles a file.  When a group fails, its files are tried one by one: a file that
is itself at fault gets a failed row with its error, and the others go on.  A
passing error (an unreachable store) leaves the trigger open instead, so its
files are listed again.  UNIQUE looks inside a batch; ``unique_in_table`` also
looks into the clean table.
"""

from __future__ import annotations

import hashlib
import re
import time
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.evolve import SchemaDriftError
from ..operators.rules import RuleError, RuleSet
from ..plans.pipeline import log_failure, read_run_log, run_batch
from ..settings import TableSpec
from ..sources.admission import admitted
from ..sources.files import format_of, read_raw
from ..sources.headers import file_headers, header_print

MOST_COLUMNS = 512  # of a landed CSV file; a wider one raises

BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


#: what the text of a read error says when the file itself is at fault
BAD_FILE = re.compile(r"not a parquet file|malformed|corrupt|invalid utf-8|FAILED_READ_FILE\.(PARQUET|CANNOT_READ)|UNABLE_TO_INFER_SCHEMA|CANNOT_READ_FILE_FOOTER|could not read footer", re.I)


def is_lasting(exc: BaseException) -> bool:
    """Whether trying again cannot help: the file, its schema or the rules are at fault."""
    return isinstance(exc, (AnalysisException, SchemaDriftError, RuleError, ValueError)) or bool(BAD_FILE.search(str(exc)))


def batch_name(paths: list[str]) -> str:
    """The batch id of files that run together: a file's path, or a digest of all of them."""
    if len(paths) == 1:
        return f"file:{paths[0]}"
    return "files:" + hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def by_header(spark: SparkSession, paths: list[str], fmt: str | None = None) -> list[list[str]]:
    """The files of one trigger in groups that one plan can read: CSV files by their header, other files each alone."""
    csv = [p for p in paths if (fmt or format_of(p)) == "csv"]
    groups: dict[object, list[str]] = {p: [p] for p in paths if p not in csv}
    if len(csv) == 1:
        groups[csv[0]] = csv
    elif csv:
        heads = file_headers(spark, csv, width=MOST_COLUMNS)
        # the CSV scan names its files URL-encoded, the listing does not; one row per file of the trigger
        found = {unquote(r["file"]).split(":", 1)[-1].lstrip("/"): r["print"] for r in heads.select("file", header_print(F.col("columns")).alias("print")).collect()}
        for p in csv:
            groups.setdefault(found.get(p.split(":", 1)[-1].lstrip("/"), p), []).append(p)
    return sorted(groups.values())


@dataclass
class IngestConfig:
    fmt: str | None = None  # None: each file by its extension
    infer: bool = True  # header + inferred types per file (the batch job's read)
    max_files_per_trigger: int = 1
    available_now: bool = True
    query_name: str = "ingest"
    checkpoint: str | None = None
    unique_in_table: str | None = None  # a key that must be new to the clean table, too


def start_file_ingest(
    spark: SparkSession,
    spec: TableSpec,
    rules: RuleSet,
    source_schema: StructType | None = None,
    config: IngestConfig = IngestConfig(),
) -> StreamingQuery:
    """Start (and with ``available_now`` drain) the ingest stream.

    ``source_schema``: read every file with this schema instead of its
    header (no per-file drift then); default: per-file header + inference.
    """
    listing = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE_SCHEMA)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", config.max_files_per_trigger)
        .load(spec.raw_path)
        .select("path", "length")
    )
    checkpoint = config.checkpoint or f"{spec.logs_path}/_checkpoints/{config.query_name}"

    def run(paths: list[str]) -> None:
        raw = read_raw(spark, paths if len(paths) > 1 else paths[0], fmt=config.fmt or format_of(paths[0]), schema=source_schema, infer=config.infer)
        run_batch(spark, raw, spec, rules, batch_id=batch_name(paths), log_failures=False, unique_in_table=config.unique_in_table)

    def process(files: DataFrame, epoch_id: int) -> None:
        # the stream lists only under the raw prefix; admission (S3) checks the rest
        ok = files.filter(admitted(F.col("path"), F.col("length"), ""))
        paths = [r["path"] for r in ok.select("path").orderBy("path").collect()]  # at most max_files_per_trigger
        passing: Exception | None = None
        for group in by_header(spark, paths, config.fmt):
            started = time.time()
            try:
                run(group)
            except Exception as exc:  # noqa: BLE001 - judged and recorded below
                # one bad file must not fail those that share its header: each is tried alone
                for path in group:
                    try:
                        if len(group) == 1:
                            raise exc
                        run([path])
                    except Exception as own:  # noqa: BLE001
                        if not is_lasting(own):
                            passing = own  # an unreachable store, a lost executor: the file is tried again
                        else:
                            log_failure(spark, spec, batch_name([path]), started, own)
        if passing is not None:
            # the trigger stays open: a restart lists these files again, and what is committed is skipped
            raise passing

    writer = listing.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint).queryName(config.query_name)
    writer = writer.trigger(availableNow=True) if config.available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def ingest_outcomes(spark: SparkSession, spec: TableSpec) -> DataFrame:
    """Number of batches that succeeded and failed, per table."""
    log = read_run_log(spark, spec)
    return log.groupBy("table_name").agg(
        F.count_if(F.col("success")).alias("succeeded"),
        F.count_if(~F.col("success")).alias("failed"),
    )
