"""Apply a rule set to a batch: flag, split, and per-rule results.

One evaluation produces a *flagged* DataFrame: the input columns plus
``_failed_rules`` (names of every failed rule, any severity) and ``_valid``
(no ERROR rule failed).  Valid and invalid rows are two filters of that one
plan, so ``valid + invalid = total`` holds by construction.

UNIQUE without a hot task
-------------------------
"First occurrence of each key" is usually written as ``row_number()`` over a
window partitioned by the key.  That puts every row of a key in one task: a
key (or the NULL key) holding a third of the batch would make one task sort a
third of the data.  Here the first occurrence is found with an aggregate
instead -- ``min(struct(order_by..., row id))`` per key, which Spark combines
map-side, so a hot key costs one small row per map task -- and joined back on
the key with null-safe equality.  The join side per key is a single row, so
AQE's skew-join handling can split a hot key's rows over many tasks.  With
a single fixed-width order column (the default row id) the aggregate is a
plain ``min`` and runs hash-based.  A multi-column order takes two phases: keys
are counted (hash-based, two narrow columns), and only rows whose key repeats
meet ``min(struct)``, which Spark aggregates sort-based.

Row identity: the struct ends with a row id so that exactly one row per key
wins even among identical rows.  Give ``row_id`` columns that are unique
within a key (or ``[]`` when ``order_by`` already is); by default a
``monotonically_increasing_id`` is used, which is stable only when the input
is a file scan or a materialised (checkpointed / persisted) DataFrame.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass, field
from collections.abc import Iterable, Iterator

from pyspark.errors import IllegalArgumentException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.lineage import FAILED, ROW_ID, VALID
from .rules import CUSTOM, ERROR, PATTERN, UNIQUE, Rule, RuleError, RuleSet, _column_type, has_column

RESULT_SCHEMA = (
    "rule_name string, column_name string, passed boolean, failed_count bigint, "
    "total_count bigint, failure_percentage double, severity string, error_message string"
)


@dataclass
class Validated:
    flagged: DataFrame
    rules: RuleSet
    applied: list[Rule]
    rule_errors: dict[str, str] = field(default_factory=dict)

    @property
    def valid(self) -> DataFrame:
        return self.flagged.filter(F.col(VALID)).drop(FAILED, VALID)

    @property
    def invalid(self) -> DataFrame:
        return self.flagged.filter(~F.col(VALID)).drop(VALID)

    def results(self) -> DataFrame:
        """V9: one row per rule; the counts come from a single aggregate."""
        spark = self.flagged.sparkSession
        aggs = [F.count(F.lit(1)).alias("_total")]
        for i, r in enumerate(self.applied):
            aggs.append(F.count_if(F.array_contains(F.col(FAILED), r.name)).alias(f"_f{i}"))
        counts = self.flagged.agg(*aggs)
        rows: list[Column] = []
        total = F.col("_total")
        for i, r in enumerate(self.applied):
            failed = F.col(f"_f{i}")
            rows.append(
                F.struct(
                    F.lit(r.name).alias("rule_name"),
                    F.lit(r.column).cast("string").alias("column_name"),
                    (failed == 0).alias("passed"),
                    failed.alias("failed_count"),
                    total.alias("total_count"),
                    F.when(total > 0, failed.cast("double") / total.cast("double") * 100.0)
                    .otherwise(F.lit(0.0))
                    .alias("failure_percentage"),
                    F.lit(r.severity).alias("severity"),
                    F.lit(None).cast("string").alias("error_message"),
                )
            )
        for name, message in self.rule_errors.items():
            r = next(x for x in self.rules if x.name == name)
            rows.append(
                F.struct(
                    F.lit(r.name).alias("rule_name"),
                    F.lit(r.column).cast("string").alias("column_name"),
                    F.lit(False).alias("passed"),
                    F.lit(0).cast("bigint").alias("failed_count"),
                    F.lit(0).cast("bigint").alias("total_count"),
                    F.lit(0.0).alias("failure_percentage"),
                    F.lit(r.severity).alias("severity"),
                    F.lit(message).alias("error_message"),
                )
            )
        if not rows:
            return spark.createDataFrame([], RESULT_SCHEMA)
        return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


@contextmanager
def error_free(df: DataFrame) -> Iterator[None]:
    """Expressions resolved inside give NULL where a value does not fit, instead of failing the job.

    Casts, arithmetic and lookups take their error behaviour when they are
    resolved, so only what is built inside is affected.
    """
    conf = df.sparkSession.conf
    before = conf.get("spark.sql.ansi.enabled")
    conf.set("spark.sql.ansi.enabled", "false")
    try:
        yield
    finally:
        conf.set("spark.sql.ansi.enabled", before)


def check_pattern(df: DataFrame, pattern: str) -> None:
    """Compile a PATTERN rule's expression up front; raises RuleError when it is none."""
    try:
        df.sparkSession._jvm.java.util.regex.Pattern.compile(pattern)
    except IllegalArgumentException as exc:  # a PatternSyntaxException is one
        raise RuleError(f"invalid pattern {pattern!r}: {exc}") from None


def failing_rules(df: DataFrame, rules: Iterable[Rule]) -> dict[str, str]:
    """Name and error of every CUSTOM rule that cannot be evaluated over ``df``, each tried alone.

    For after a job over the flagged rows has failed: an expression may still
    raise by itself (``raise_error``, a user function).
    """
    errors = {}
    for r in rules:
        if r.rule_type == CUSTOM:
            try:
                with error_free(df):
                    probe = df.select(r.predicate(df.schema).alias("ok"))
                probe.agg(F.count_if("ok")).collect()
            except Exception as exc:  # noqa: BLE001 - reported as a result row
                errors[r.name] = str(exc)
    return errors


def validate(
    df: DataFrame,
    rules: RuleSet | Iterable[Rule],
    row_id: list[str] | None = None,
    on_rule_error: str = "report",
    known_errors: dict[str, str] | None = None,
) -> Validated:
    """Flag every row against ``rules``.

    ``on_rule_error``: "report" (the rule is left out of the split and shows
    up in ``results()`` with its error, V10) or "fail" (raise before any job).
    ``known_errors``: rules found to fail when they ran (``failing_rules``),
    reported likewise.  A value that a rule's expression cannot cast or divide
    fails that row, not the job.
    """
    rules = rules if isinstance(rules, RuleSet) else RuleSet(tuple(rules))
    schema = df.schema
    applied: list[Rule] = []
    errors: dict[str, str] = {}
    predicates: dict[str, Column] = {}

    # Analyse every rule against the schema before anything runs.
    for r in rules:
        if r.name in (known_errors or {}):
            errors[r.name] = known_errors[r.name]
            continue
        try:
            if r.rule_type == UNIQUE:
                if r.column is None or not has_column(schema, r.column):
                    raise RuleError(f"rule {r.name}: column {r.column!r} not found")
                missing = [c for c in r.params.get("order_by", []) if not has_column(schema, c)]
                if missing:
                    raise RuleError(f"rule {r.name}: order_by columns not found: {missing}")
            else:
                if r.rule_type == PATTERN:
                    check_pattern(df, r.params.get("pattern") or "")
                p = r.predicate(schema)
                with error_free(df):
                    df.limit(0).select(p)  # resolves the expression; no job runs
                predicates[r.name] = p
            applied.append(r)
        except Exception as exc:  # noqa: BLE001 - reported as a result row
            if on_rule_error == "fail":
                raise
            errors[r.name] = str(exc)

    work = df
    uniques = [r for r in applied if r.rule_type == UNIQUE]
    if uniques:
        if row_id is None:
            work = work.withColumn(ROW_ID, F.monotonically_increasing_id())
            row_id = [ROW_ID]
        for i, r in enumerate(uniques):
            work, passed = _first_occurrence(work, r, row_id, i)
            predicates[r.name] = passed

    failed = F.array_compact(
        F.array(*[F.when(~predicates[r.name], F.lit(r.name)) for r in applied])
    ) if applied else F.array().cast("array<string>")
    error_rules = [r for r in applied if r.severity == ERROR]
    valid = F.lit(True)
    for r in error_rules:
        valid = valid & predicates[r.name]

    with error_free(df):
        flagged = work.select(*[F.col(f"`{c}`") for c in df.columns], failed.alias(FAILED), valid.alias(VALID))
    return Validated(flagged=flagged, rules=rules, applied=applied, rule_errors=errors)


def _first_occurrence(df: DataFrame, rule: Rule, row_id: list[str], i: int) -> tuple[DataFrame, Column]:
    key = F.col(f"`{rule.column}`")
    order_cols = list(rule.params.get("order_by", [])) + list(row_id)
    if not order_cols:
        raise RuleError(f"rule {rule.name}: no order_by and no row id")
    fixed = ("bigint", "int", "smallint", "tinyint", "double", "float", "date", "timestamp", "timestamp_ntz", "boolean")
    if len(order_cols) == 1 and _column_type(df.schema, order_cols[0], rule.name).simpleString() in fixed:
        # one fixed-width column: a plain min keeps the aggregate hash-based
        order = F.col(f"`{order_cols[0]}`")
    else:
        # NULLs come last, as in the plain minimum above
        order = F.struct(*[x for c in order_cols for x in (F.col(f"`{c}`").isNull().alias(f"{c}_null"), F.col(f"`{c}`"))])
    keyed = df.withColumn(f"_uo{i}", order)
    if not _is_struct(keyed, f"_uo{i}"):
        firsts = keyed.select(key.alias(f"_uk{i}"), F.col(f"_uo{i}")).groupBy(f"_uk{i}").agg(F.min(f"_uo{i}").alias(f"_uf{i}"))
    else:
        # hash-aggregated counts first: only rows of keys that repeat are ordered
        repeated = df.groupBy(key.alias(f"_ur{i}")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(f"_ur{i}")
        again = keyed.select(key.alias(f"_uk{i}"), F.col(f"_uo{i}")).join(repeated, F.col(f"_uk{i}").eqNullSafe(F.col(f"_ur{i}")), "left_semi")
        firsts = again.groupBy(f"_uk{i}").agg(F.min(f"_uo{i}").alias(f"_uf{i}"))
    joined = keyed.join(firsts.withColumn(f"_um{i}", F.lit(True)), key.eqNullSafe(F.col(f"_uk{i}")), "left")
    # a key without a partner stands once; null-safe: a row with a NULL order value is either first or not, never lost
    return joined, F.col(f"_um{i}").isNull() | F.col(f"_uo{i}").eqNullSafe(F.col(f"_uf{i}"))


def _is_struct(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, StructType)
