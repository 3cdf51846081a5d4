"""File scans.

``read_raw`` reads one incoming batch.  The format follows the file
extension (csv / json / parquet).  With a registered schema the text formats
are best read as all-string columns and typed by ``operators.evolve.conform``
(``try_cast``), so one bad cell cannot flip a column's inferred type for the
whole batch; ``infer=True`` keeps the header + inference behaviour.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# The admitted file extensions and their formats.
FORMATS = {".csv": "csv", ".json": "json", ".parquet": "parquet"}


def format_of(path: str) -> str:
    lower = path.lower().rstrip("/")
    for ext, fmt in FORMATS.items():
        if lower.endswith(ext):
            return fmt
    raise ValueError(f"unsupported file type: {path}")


def read_raw(
    spark: SparkSession,
    path: str | list[str],
    fmt: str | None = None,
    schema: StructType | None = None,
    infer: bool = True,
    options: dict | None = None,
) -> DataFrame:
    """Header CSV with inference by default; JSON and Parquet by extension."""
    fmt = fmt or format_of(path if isinstance(path, str) else path[0])
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("mode", "PERMISSIVE")
        if schema is None:
            reader = reader.option("inferSchema", infer)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)
