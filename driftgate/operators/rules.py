"""Declarative row rules.

A ``Rule`` compiles to one Boolean ``Column`` that is TRUE when the row
passes.  Every predicate is wrapped in ``coalesce(..., false)``: a NULL
predicate is a failure, so each row lands in exactly one of valid/invalid.
UNIQUE is the one rule that needs more than the row; ``validate`` evaluates
it with an aggregate + join (see there).
"""

from __future__ import annotations

import datetime as _dt
import decimal as _decimal
import json
from dataclasses import dataclass, field
from typing import Any, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType, StructType

ERROR, WARNING, INFO = "error", "warning", "info"
SEVERITIES = (ERROR, WARNING, INFO)

NOT_NULL, UNIQUE, RANGE, DATATYPE, PATTERN, CUSTOM = (
    "not_null",
    "unique",
    "range",
    "datatype",
    "pattern",
    "custom",
)
RULE_TYPES = (NOT_NULL, UNIQUE, RANGE, DATATYPE, PATTERN, CUSTOM)


class RuleError(ValueError):
    """A rule that cannot be evaluated against the given schema."""


@dataclass(frozen=True)
class Rule:
    name: str
    rule_type: str
    column: str | None
    severity: str = ERROR
    params: dict[str, Any] = field(default_factory=dict, hash=False, compare=False)
    description: str = ""

    def __post_init__(self):
        if self.rule_type not in RULE_TYPES:
            raise RuleError(f"unsupported rule type: {self.rule_type}")
        if self.severity not in SEVERITIES:
            raise RuleError(f"unsupported severity: {self.severity}")

    # -- constructors -----------------------------------------------------
    @staticmethod
    def not_null(column: str, name: str | None = None, severity: str = ERROR, description: str = "") -> "Rule":
        return Rule(name or f"{column}_not_null", NOT_NULL, column, severity, {}, description)

    @staticmethod
    def unique(
        column: str,
        name: str | None = None,
        severity: str = ERROR,
        order_by: Iterable[str] = (),
        description: str = "",
    ) -> "Rule":
        """First occurrence of each key passes; later ones fail; NULL keys form one group.

        ``order_by`` defines "first"; rows still tied are ordered by the row id
        ``validate`` assigns (input order of a file scan).
        """
        return Rule(name or f"{column}_unique", UNIQUE, column, severity, {"order_by": list(order_by)}, description)

    @staticmethod
    def range(
        column: str,
        min: Any = None,
        max: Any = None,
        name: str | None = None,
        severity: str = ERROR,
        description: str = "",
    ) -> "Rule":
        params = {k: v for k, v in (("min", min), ("max", max)) if v is not None}
        return Rule(name or f"{column}_range", RANGE, column, severity, params, description)

    @staticmethod
    def datatype(column: str, expected_type: str, name: str | None = None, severity: str = ERROR, description: str = "") -> "Rule":
        return Rule(name or f"{column}_datatype", DATATYPE, column, severity, {"expected_type": expected_type}, description)

    @staticmethod
    def pattern(column: str, pattern: str, name: str | None = None, severity: str = ERROR, description: str = "") -> "Rule":
        return Rule(name or f"{column}_pattern", PATTERN, column, severity, {"pattern": pattern}, description)

    @staticmethod
    def expr(name: str, condition: str | Column, column: str | None = None, severity: str = ERROR, description: str = "") -> "Rule":
        """CUSTOM: a SQL boolean expression (or a Column) that is TRUE for passing rows."""
        return Rule(name, CUSTOM, column, severity, {"condition": condition}, description)

    # -- evaluation -------------------------------------------------------
    def predicate(self, schema: StructType) -> Column:
        """Boolean column, TRUE = passes.  Raises RuleError if it cannot apply."""
        if self.rule_type == CUSTOM:
            cond = self.params.get("condition")
            if cond is None:
                raise RuleError(f"rule {self.name}: missing condition")
            c = F.expr(cond) if isinstance(cond, str) else cond
            return F.coalesce(c.cast("boolean"), F.lit(False))
        dtype = _column_type(schema, self.column, self.name)
        c = F.col(_quote(self.column))
        if self.rule_type == NOT_NULL:
            return c.isNotNull()
        if self.rule_type == UNIQUE:
            raise RuleError(f"rule {self.name}: UNIQUE is evaluated by validate()")
        if self.rule_type == RANGE:
            lo, hi = self.params.get("min"), self.params.get("max")
            v = _comparable(c, dtype, lo if lo is not None else hi)
            cond = F.lit(True)
            if lo is not None:
                cond = cond & (v >= F.lit(lo))
            if hi is not None:
                cond = cond & (v <= F.lit(hi))
            return F.coalesce(cond, F.lit(False))
        if self.rule_type == DATATYPE:
            expected = self.params.get("expected_type")
            if not expected:
                raise RuleError(f"rule {self.name}: expected_type parameter required")
            return c.try_cast(expected).isNotNull()
        if self.rule_type == PATTERN:
            pattern = self.params.get("pattern")
            if not pattern:
                raise RuleError(f"rule {self.name}: pattern parameter required")
            text = c if dtype.simpleString() == "string" else c.cast("string")
            return F.coalesce(F.regexp_extract(text, pattern, 0) != F.lit(""), F.lit(False))
        raise RuleError(f"unsupported rule type: {self.rule_type}")

    def to_dict(self) -> dict[str, Any]:
        params = {k: (v if isinstance(v, (str, int, float, list, type(None))) else str(v)) for k, v in self.params.items()}
        return {
            "rule_name": self.name,
            "rule_type": self.rule_type,
            "column_name": self.column,
            "severity": self.severity,
            "parameters": params,
            "description": self.description,
        }


def _quote(name: str) -> str:
    return name if name.startswith("`") else f"`{name}`"


def _column_type(schema: StructType, column: str | None, rule: str) -> DataType:
    if column is None:
        raise RuleError(f"rule {rule}: no column")
    for f in schema.fields:
        if f.name == column:
            return f.dataType
    if not _case_sensitive():
        for f in schema.fields:
            if f.name.lower() == column.lower():
                return f.dataType
    raise RuleError(f"rule {rule}: column {column!r} not found")


def _case_sensitive() -> bool:
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    return spark is not None and spark.conf.get("spark.sql.caseSensitive", "false").lower() == "true"


def has_column(schema: StructType, column: str) -> bool:
    """Name resolution as Spark does it (``spark.sql.caseSensitive``)."""
    try:
        _column_type(schema, column, "")
        return True
    except RuleError:
        return False


def _comparable(c: Column, dtype: DataType, sample: Any) -> Column:
    """Bring a column to a type comparable with the bound without ANSI errors."""
    if isinstance(sample, bool):
        return c.try_cast("boolean")
    if isinstance(sample, (int, float)):
        return c if isinstance(dtype, NumericType) else c.try_cast("double")
    if isinstance(sample, _decimal.Decimal):
        return c if isinstance(dtype, NumericType) else c.try_cast("decimal(38,10)")
    if isinstance(sample, _dt.datetime):
        return c.try_cast("timestamp")
    if isinstance(sample, _dt.date):
        return c.try_cast("date")
    return c.cast("string")


@dataclass(frozen=True)
class RuleSet:
    """Immutable ordered collection of rules."""

    rules: tuple[Rule, ...] = ()

    def __post_init__(self):
        names = [r.name for r in self.rules]
        if len(set(names)) < len(names):
            raise RuleError(f"duplicate rule name: {max(names, key=names.count)}")

    def add(self, rule: Rule) -> "RuleSet":
        if any(r.name == rule.name for r in self.rules):
            raise RuleError(f"duplicate rule name: {rule.name}")
        return RuleSet(self.rules + (rule,))

    def add_all(self, rules: Iterable[Rule]) -> "RuleSet":
        out = self
        for r in rules:
            out = out.add(r)
        return out

    def clear(self) -> "RuleSet":
        return RuleSet(())

    def __iter__(self):
        return iter(self.rules)

    def __len__(self):
        return len(self.rules)

    def to_dict(self) -> list[dict[str, Any]]:
        return [r.to_dict() for r in self.rules]

    def to_json(self) -> str:
        return json.dumps(self.to_dict())


def orders_rules(unique_order_by: Iterable[str] = ()) -> RuleSet:
    """The orders preset (V13): six ERROR rules."""
    # Rule names, columns and bounds of the orders preset.
    return RuleSet(
        (
            Rule.not_null("order_id", "order_id_not_null", description="Order ID must not be null"),
            Rule.unique("order_id", "order_id_unique", order_by=unique_order_by, description="Order ID must be unique"),
            Rule.range("price", min=0, name="price_positive", description="Price must be greater than or equal to 0"),
            Rule.range("quantity", min=1, name="quantity_positive", description="Quantity must be at least 1"),
            Rule.not_null("order_date", "order_date_not_null", description="Order date must not be null"),
            Rule.not_null("customer_id", "customer_id_not_null", description="Customer ID must not be null"),
        )
    )
