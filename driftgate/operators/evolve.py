"""Schema drift handling.

``conform`` brings a DataFrame to a registered schema in ONE ``select``:
registered columns in registered order, cast with ``try_cast`` (a value
that does not fit becomes NULL instead of failing the batch under ANSI),
missing columns as typed NULLs, and -- in "evolve" mode -- the new columns
after them.  Structs are conformed field by field (dotted-path drift), arrays
element-wise.  ``rescue=True`` keeps the original text of every cell whose cast
lost something -- it became NULL, or a value that does not lead back to the
original (2.7 as 2) -- in ``_rescued map<string,string>``, nested cells by path
(``a.b``, ``items[0].n``).
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DateType, MapType, NumericType, StringType, StructType, TimestampNTZType, TimestampType

from ..functions.lineage import LINEAGE, RESCUED
from ..functions.types import type_name
from .schema_diff import Comparison

MODES = ("evolve", "match", "strict")


class SchemaDriftError(ValueError):
    pass


def _key_fn():
    """Column names as Spark resolves them (``spark.sql.caseSensitive``, default off);
    the setting is read once per call of the public functions."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    sensitive = spark is not None and spark.conf.get("spark.sql.caseSensitive", "false").lower() == "true"
    return (lambda name: name) if sensitive else (lambda name: name.lower())


def _conform_col(c: Column, src: DataType, dst: DataType, keep_new: bool, _key=str.lower) -> Column:
    if type_name(src) == type_name(dst):
        return c
    if isinstance(src, StructType) and isinstance(dst, StructType):
        src_fields = {_key(f.name): f for f in src.fields}
        parts = []
        for f in dst.fields:
            sf = src_fields.get(_key(f.name))
            if sf is None:
                parts.append(F.lit(None).cast(f.dataType).alias(f.name))
            else:
                parts.append(_conform_col(c.getField(sf.name), sf.dataType, f.dataType, keep_new, _key).alias(f.name))
        if keep_new:
            dst_names = {_key(f.name) for f in dst.fields}
            parts.extend(c.getField(f.name).alias(f.name) for f in src.fields if _key(f.name) not in dst_names)
        return F.when(c.isNull(), F.lit(None)).otherwise(F.struct(*parts))
    if isinstance(src, ArrayType) and isinstance(dst, ArrayType):
        return F.transform(c, lambda x: _conform_col(x, src.elementType, dst.elementType, keep_new, _key))
    return c.try_cast(dst)


def _lost(c: Column, typed: Column, src: DataType, dst: DataType) -> Column:
    """Whether a cast keeps less than the cell had: nothing at all, or a value that does not lead back to it.

    Text is read, not converted: digits beyond a decimal's scale are rounded as any reader rounds them.
    """
    nothing = typed.isNull()
    if isinstance(src, NumericType) and isinstance(dst, NumericType):
        return nothing | ~typed.try_cast(src).eqNullSafe(c)
    if isinstance(src, (TimestampType, TimestampNTZType)) and isinstance(dst, DateType):
        return nothing | ~typed.cast(src).eqNullSafe(c)
    if isinstance(src, StringType) and isinstance(dst, DateType):
        return nothing | (c.try_cast("timestamp_ntz") != typed.cast("timestamp_ntz"))
    return nothing


def _rescued_cells(c: Column, src: DataType, dst: DataType, path: Column, keep_new: bool, _key) -> Column | None:
    """``array<struct<k, v>>``: path and original text of every cell under ``c`` that its cast lost; None: none can be."""
    if type_name(src) == type_name(dst):
        return None
    none = F.array().cast("array<struct<k:string,v:string>>")
    if isinstance(src, StructType) and isinstance(dst, StructType):
        by_name = {_key(f.name): f for f in src.fields}
        parts = []
        for f in dst.fields:
            sf = by_name.get(_key(f.name))
            if sf is not None:
                cells = _rescued_cells(c.getField(sf.name), sf.dataType, f.dataType, F.concat(path, F.lit(f".{f.name}")), keep_new, _key)
                parts += [cells] if cells is not None else []
        return F.concat(*parts) if parts else None
    if isinstance(src, ArrayType) and isinstance(dst, ArrayType):

        def element(x: Column, i: Column) -> Column:
            at = F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))
            cells = _rescued_cells(x, src.elementType, dst.elementType, at, keep_new, _key)
            return none if cells is None else cells

        return F.coalesce(F.flatten(F.transform(c, element)), none)
    typed = _conform_col(c, src, dst, keep_new, _key)
    text = F.to_json(c) if isinstance(src, (StructType, ArrayType, MapType)) else c.cast("string")
    return F.when(c.isNotNull() & _lost(c, typed, src, dst), F.array(F.struct(path.alias("k"), text.alias("v")))).otherwise(none)


def conform(
    df: DataFrame,
    registered: StructType,
    keep_new: bool = True,
    rescue: bool = False,
    lineage: Collection[str] = LINEAGE,
) -> DataFrame:
    """One projection onto ``registered`` (+ new columns when ``keep_new``)."""
    _key = _key_fn()
    by_name = {_key(f.name): f for f in df.schema.fields}
    reg_names = {_key(f.name) for f in registered.fields}
    out: list[Column] = []
    rescued: list[Column] = []
    for f in registered.fields:
        src = by_name.get(_key(f.name))
        if src is None:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))  # E4
            continue
        c = F.col(f"`{src.name}`")
        typed = _conform_col(c, src.dataType, f.dataType, keep_new, _key)  # E5
        out.append(typed.alias(f.name))
        if rescue:
            cells = _rescued_cells(c, src.dataType, f.dataType, F.lit(f.name), keep_new, _key)
            rescued += [cells] if cells is not None else []
    extra = [
        f for f in df.schema.fields if _key(f.name) not in reg_names and (keep_new or f.name in lineage)
    ]
    out.extend(F.col(f"`{f.name}`") for f in extra if f.name != RESCUED)  # E3 (+ lineage columns)
    if rescue:
        entries = F.concat(*rescued) if rescued else F.array().cast("array<struct<k:string,v:string>>")
        out.append(F.map_from_entries(entries).alias(RESCUED))
    return df.select(*out)


def evolve(
    df: DataFrame,
    comparison: Comparison,
    mode: str = "evolve",
    rescue: bool = False,
) -> DataFrame:
    """Decision order: no changes -> unchanged (E1); strict -> error (E2);
    match -> registered schema only (E7); evolve -> registered order + new
    columns, missing ones added as NULL, types cast (E3-E6)."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if comparison.is_new_table or not comparison.has_changes:
        return df
    if mode == "strict":
        raise SchemaDriftError(f"schema changes in strict mode: {[c.to_dict() for c in comparison.changes]}")
    return conform(df, comparison.registered, keep_new=(mode == "evolve"), rescue=rescue)


def evolved_schema(comparison: Comparison, mode: str = "evolve") -> StructType | None:
    """The schema to publish after a successful evolve (E8): registered order, then new columns."""
    if comparison.registered is None:
        return comparison.incoming
    if mode != "evolve":
        return comparison.registered
    _key = _key_fn()
    reg_names = {_key(f.name) for f in comparison.registered.fields}
    fields = list(comparison.registered.fields) + [f for f in comparison.incoming.fields if _key(f.name) not in reg_names]
    return StructType(fields)
