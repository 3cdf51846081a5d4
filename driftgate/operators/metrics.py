"""Quality metrics.

Everything is computed by two aggregates and stays a lazy one-row
DataFrame:

* over the flagged batch: total / valid / invalid and the failed count of
  every rule (M1, V9) -- one pass;
* over the raw batch: rows grouped by a 128-bit print of their values and their
  NULL bits give the whole-row duplicates (M2) and the NULL/NaN counts (M3) in
  one pass.  The group-by combines map-side, so a group of identical copies holding a third of
  the batch shrinks to one row per map task, and no row travels whole.

The two one-row results are merged without a cross join: both are unpivoted
to ``(key, value)`` rows, unioned, and folded into one map.

Score (M5): 40*valid/total + 30*(total-dup)/total + 30*(cells-nulls)/cells,
cells = total * columns.  It is computed as one exact fraction and rounded
half-up to 2 decimals; 0 for an empty batch.
"""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, MapType, StructType

from ..functions.lineage import LINEAGE, NULL_CELLS, ROW_PRINT
from ..functions.rounding import half_up_ratio
from .quantiles import exact_quantiles
from .validate import FAILED, VALID, Validated

# Score weights.
W_VALID, W_UNIQUE, W_COMPLETE = 40, 30, 30

_WORD = 63  # NULL bits to a number


def business_columns(df: DataFrame, lineage: Collection[str] = LINEAGE) -> list[str]:
    return [c for c in df.columns if c not in lineage]


def _is_null(df: DataFrame, name: str) -> Column:
    c = F.col(f"`{name}`")
    dt = df.schema[name].dataType
    if isinstance(dt, (FloatType, DoubleType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def profile_columns(raw: DataFrame, columns: list[str] | None = None) -> list[Column]:
    """What M2 and M3 need of a row: its 128-bit print and a bit for each NULL (NaN) cell.

    Two rows are copies when they agree on every value, NULLs and NaNs
    included.  Nested values enter the print as JSON text.  The print is two
    64-bit hashes from different seeds; among n different rows the odds that
    any two share it are below n * n / 2**129 (10**12 rows: 2 in 10**15).
    """
    cols = columns or business_columns(raw)
    parts = []
    for c in cols:
        x = F.col(f"`{c}`")
        if isinstance(raw.schema[c].dataType, (ArrayType, MapType, StructType)):
            x = F.to_json(x, {"ignoreNullFields": "false"})
        parts += [x.isNull(), x]
    prints = F.struct(F.xxhash64(F.lit(0), *parts).alias("a"), F.xxhash64(F.lit(1), *parts).alias("b"))
    # one bit a column, 63 to a number
    words = []
    for lo in range(0, max(len(cols), 1), _WORD):
        bits = [F.when(_is_null(raw, c), F.lit(1 << i).cast("bigint")).otherwise(F.lit(0)) for i, c in enumerate(cols[lo : lo + _WORD])]
        words.append(reduce(add, bits, F.lit(0).cast("bigint")).alias(f"w{lo // _WORD}"))
    return [prints.alias(ROW_PRINT), F.struct(*words).alias(NULL_CELLS)]


def row_profile(raw: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """M2 + M3: one row ``(rows, duplicate_records, null_<c>...)``.

    One pass: rows are grouped by print and NULL bits, so the shuffle carries a
    few numbers for each row, whatever its width; copies are combined map-side.
    Rows that bring their profile columns along (``run_batch``) are not
    profiled again.
    """
    cols = columns or business_columns(raw)
    own = raw if ROW_PRINT in raw.columns else raw.select(*profile_columns(raw, cols))
    keys = [F.col(ROW_PRINT)["a"].alias("a"), F.col(ROW_PRINT)["b"].alias("b")]
    keys += [F.col(NULL_CELLS)[f"w{i}"].alias(f"w{i}") for i in range(-(-max(len(cols), 1) // _WORD))]
    groups = own.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    nulls = [F.sum(F.when(F.bit_get(f"w{i // _WORD}", F.lit(i % _WORD)) == 1, F.col("n")).otherwise(F.lit(0))).alias(f"null_{c}") for i, c in enumerate(cols)]
    return groups.agg(F.sum("n").alias("rows"), F.sum(F.col("n") - 1).alias("duplicate_records"), *nulls)


def null_counts(raw: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """M3 alone: one aggregate, ``(column_name, null_count)`` rows."""
    cols = columns or business_columns(raw)
    agg = raw.agg(*[F.count_if(_is_null(raw, c)).alias(f"_n{i}") for i, c in enumerate(cols)])
    return agg.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("null_count")) for i, c in enumerate(cols)]))
    )


def duplicate_count(raw: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """M2 alone: ``count - count(distinct row)`` as one row (NULL for an empty table)."""
    prints = raw.select(profile_columns(raw, columns)[0]).groupBy(F.col(ROW_PRINT)["a"], F.col(ROW_PRINT)["b"]).agg(F.count(F.lit(1)).alias("n"))
    return prints.agg(F.sum(F.col("n") - 1).alias("duplicate_records"))


def collect_metrics(
    raw: DataFrame,
    validated: Validated,
    table_name: str,
    schema_changes: list[dict] | None = None,
    columns: list[str] | None = None,
    execution_ts: Column | None = None,
) -> DataFrame:
    """The metrics row (M1-M5, M8) as a lazy one-row DataFrame."""
    cols = columns or business_columns(raw)
    applied = validated.applied
    flag_aggs = [
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(VALID)).alias("valid"),
        F.count_if(~F.col(VALID)).alias("invalid"),
    ] + [F.count_if(F.array_contains(F.col(FAILED), r.name)).alias(f"rule{i}") for i, r in enumerate(applied)]
    a = validated.flagged.agg(*flag_aggs)
    a_kv = a.select(
        F.explode(F.create_map(*[x for n in a.columns for x in (F.lit(n), F.col(n).cast("bigint"))]))
    )
    p = row_profile(raw, cols)
    p_kv = p.select(
        F.explode(F.create_map(*[x for n in p.columns for x in (F.lit(n), F.col(n).cast("bigint"))]))
    )
    m = a_kv.unionByName(p_kv).agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("m"))

    g = lambda k: F.coalesce(F.col("m")[k], F.lit(0).cast("bigint"))
    total, valid, invalid, dup = g("total"), g("valid"), g("invalid"), g("duplicate_records")
    nulls_total = F.lit(0).cast("bigint")
    for c in cols:
        nulls_total = nulls_total + g(f"null_{c}")
    k = max(len(cols), 1)
    numerator = (valid * (W_VALID * k) + (total - dup) * (W_UNIQUE * k) + (total * k - nulls_total) * W_COMPLETE)
    score = F.when(total > 0, half_up_ratio(numerator, total * k, 2)).otherwise(F.lit(0.0))

    results = F.array(
        *[
            F.struct(
                F.lit(r.name).alias("rule_name"),
                F.lit(r.column).cast("string").alias("column_name"),
                (g(f"rule{i}") == 0).alias("passed"),
                g(f"rule{i}").alias("failed_count"),
                total.alias("total_count"),
                F.when(total > 0, g(f"rule{i}").cast("double") / total.cast("double") * 100.0).otherwise(F.lit(0.0)).alias("failure_percentage"),
                F.lit(r.severity).alias("severity"),
                F.lit(None).cast("string").alias("error_message"),
            )
            for i, r in enumerate(applied)
        ]
        + [
            F.struct(
                F.lit(name).alias("rule_name"),
                F.lit(next(x.column for x in validated.rules if x.name == name)).cast("string").alias("column_name"),
                F.lit(False).alias("passed"),
                F.lit(0).cast("bigint").alias("failed_count"),
                F.lit(0).cast("bigint").alias("total_count"),
                F.lit(0.0).alias("failure_percentage"),
                F.lit(next(x.severity for x in validated.rules if x.name == name)).alias("severity"),
                F.lit(msg).alias("error_message"),
            )
            for name, msg in validated.rule_errors.items()
        ]
    )
    changes = schema_changes or []
    change_structs = [
        F.struct(
            F.lit(ch.get("change_type")).cast("string").alias("change_type"),
            F.lit(ch.get("column_name")).cast("string").alias("column_name"),
            F.lit(ch.get("old_type")).cast("string").alias("old_type"),
            F.lit(ch.get("new_type")).cast("string").alias("new_type"),
        )
        for ch in changes
    ]
    change_arr = (
        F.array(*change_structs)
        if change_structs
        else F.array().cast("array<struct<change_type:string,column_name:string,old_type:string,new_type:string>>")
    )
    schema_info = F.struct(
        F.array(*[F.lit(c) for c in cols]).alias("columns"),
        F.lit(len(cols)).alias("column_count"),
        change_arr.alias("schema_changes"),
    )
    null_map = F.map_from_arrays(F.array(*[F.lit(c) for c in cols]), F.array(*[g(f"null_{c}") for c in cols])) if cols else F.create_map().cast("map<string,bigint>")
    return m.select(
        F.lit(table_name).alias("table_name"),
        (execution_ts if execution_ts is not None else F.current_timestamp()).alias("execution_timestamp"),
        total.alias("total_records"),
        valid.alias("valid_records"),
        invalid.alias("invalid_records"),
        dup.alias("duplicate_records"),
        null_map.alias("null_counts"),
        nulls_total.alias("total_null_cells"),
        results.alias("validation_results"),
        schema_info.alias("schema_info"),
        score.alias("data_quality_score"),
    )


def metrics_json(metrics: DataFrame) -> DataFrame:
    """M9: the metrics row as one JSON document."""
    return metrics.select(F.to_json(F.struct(*[F.col(c) for c in metrics.columns])).alias("json"))


def numeric_summary(df: DataFrame, columns: list[str] | None = None, exact: bool = True, accuracy: int = 10000) -> DataFrame:
    """M4: count, mean, stddev, min, quartiles, max per numeric column.

    Output ``(column_name, count, mean, stddev, min, p25, p50, p75, max)``.
    The quartiles are exact (``operators.quantiles``, three passes over the
    columns); ``exact=False`` takes them from ``percentile_approx`` in the one
    aggregate that gives the rest.
    """
    from pyspark.sql.types import NumericType

    cols = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name in business_columns(df)]
    quartiles = [0.25, 0.5, 0.75]
    rows = []
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(f"`{c}`").cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"mean{i}"), F.stddev_samp(x).alias(f"sd{i}"), F.min(x).alias(f"min{i}"), F.max(x).alias(f"max{i}")]
        if not exact:
            aggs.append(F.percentile_approx(x, quartiles, accuracy).alias(f"q{i}"))
        got = [F.lit(c).alias("column_name"), F.col(f"n{i}").alias("count"), F.col(f"mean{i}").alias("mean"), F.col(f"sd{i}").alias("stddev"), F.col(f"min{i}").alias("min")]
        if not exact:
            got += [F.col(f"q{i}")[q].alias(f"p{round(100 * p)}") for q, p in enumerate(quartiles)]
        rows.append(F.struct(*got, F.col(f"max{i}").alias("max")))
    plain = df.agg(*aggs).select(F.inline(F.array(*rows)))
    if not exact:
        return plain
    at = lambda q: F.max(F.when(F.col("q") == q, F.col("value"))).alias(f"p{round(100 * quartiles[q])}")
    q = exact_quantiles(df, cols, accuracy=accuracy).groupBy("column_name").agg(*[at(i) for i in range(3)])
    return plain.join(q, "column_name", "left").select("column_name", "count", "mean", "stddev", "min", "p25", "p50", "p75", "max")
