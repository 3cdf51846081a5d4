"""driftgate: schema drift, row validation and quality metrics on Spark DataFrames."""

__version__ = "0.1.0"

from .operators.alerts import check_thresholds, digest
from .operators.evolve import conform, evolve
from .operators.metrics import collect_metrics, numeric_summary
from .operators.registry import SchemaRegistry
from .operators.rules import Rule, RuleSet, orders_rules
from .operators.schema_diff import batch_compatibility, detect, diff_batches, infer_batch_types
from .operators.validate import validate
from .plans.pipeline import read_layer, run_batch
from .settings import TableSpec, Thresholds
from .streaming.ingest import start_file_ingest

__all__ = [
    "Rule",
    "RuleSet",
    "SchemaRegistry",
    "TableSpec",
    "Thresholds",
    "batch_compatibility",
    "check_thresholds",
    "collect_metrics",
    "conform",
    "detect",
    "diff_batches",
    "digest",
    "evolve",
    "infer_batch_types",
    "numeric_summary",
    "orders_rules",
    "read_layer",
    "run_batch",
    "start_file_ingest",
    "validate",
]
