"""Table settings (S23) and quality thresholds (M6).

A ``TableSpec`` says where one dataset's layers live and how it is
partitioned; any number of datasets can be described.  Paths are plain
strings so they work for any Hadoop file system the cluster mounts.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Thresholds:
    # The defaults of the quality alerts.
    max_invalid_percentage: float = 5.0
    max_duplicate_percentage: float = 2.0
    min_quality_score: float = 85.0


@dataclass(frozen=True)
class TableSpec:
    name: str
    root: str
    registered_schema: StructType | None = None
    partition_by: tuple[str, ...] = ("year", "month", "day")
    date_column: str | None = "order_date"
    raw_prefix: str = "raw"
    thresholds: Thresholds = field(default_factory=Thresholds)
    # When set, the registered schema is this catalog table's (S12) and new
    # columns are added to it with ALTER TABLE ... ADD COLUMNS.
    catalog_table: str | None = None
    # Columns the quarantine keeps as the original text (default: the date column).
    quarantine_text: tuple[str, ...] | None = None

    @property
    def quarantine_text_columns(self) -> tuple[str, ...]:
        if self.quarantine_text is not None:
            return self.quarantine_text
        return (self.date_column,) if self.date_column else ()

    def layer(self, layer: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{self.name}"

    @property
    def raw_path(self) -> str:
        return self.layer(self.raw_prefix)

    @property
    def clean_path(self) -> str:
        return self.layer("clean")

    @property
    def quarantine_path(self) -> str:
        return self.layer("quarantine")

    @property
    def curated_path(self) -> str:
        return self.layer("curated")

    @property
    def logs_path(self) -> str:
        return f"{self.root.rstrip('/')}/logs/{self.name}"

    @property
    def metrics_path(self) -> str:
        return f"{self.logs_path}/metrics"

    @property
    def alerts_path(self) -> str:
        return f"{self.logs_path}/alerts"

    @property
    def run_log_path(self) -> str:
        return f"{self.logs_path}/run_log"

    @property
    def registry_path(self) -> str:
        return f"{self.root.rstrip('/')}/registry/{self.name}"
