"""Type identity helpers.

Types are named with ``DataType.simpleString()`` and parsed with
``DataType.fromDDL`` -- never by taking ``str(type)`` apart -- so decimal
precision/scale and nested types survive a round trip.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DataType,
    DoubleType,
    FloatType,
    MapType,
    StructField,
    StructType,
)

# Type changes that never lose information ("safe casts").
SAFE_WIDENINGS = frozenset(
    {
        ("int", "bigint"),
        ("float", "double"),
        ("smallint", "int"),
        ("smallint", "bigint"),
        ("int", "double"),
    }
)


def type_name(dt: DataType) -> str:
    return dt.simpleString()


def parse_type(text: str | DataType) -> DataType:
    if isinstance(text, DataType):
        return text
    return DataType.fromDDL(text)


def parse_schema(ddl: str | StructType) -> StructType:
    if isinstance(ddl, StructType):
        return ddl
    parsed = DataType.fromDDL(ddl)
    if not isinstance(parsed, StructType):
        raise ValueError(f"not a struct schema: {ddl!r}")
    return parsed


def is_safe_widening(old: str, new: str) -> bool:
    return (old, new) in SAFE_WIDENINGS


def is_floating(dt: DataType) -> bool:
    return isinstance(dt, (FloatType, DoubleType))


def flatten_fields(schema: StructType, prefix: str = "") -> list[tuple[str, DataType, int]]:
    """Leaf and container fields by dotted path with their position among siblings.

    Structs are walked; arrays and maps are leaves identified by their full
    type text, so ``array<int>`` vs ``array<bigint>`` is a type change.
    """
    out: list[tuple[str, DataType, int]] = []
    for pos, f in enumerate(schema.fields):
        path = f"{prefix}{f.name}"
        out.append((path, f.dataType, pos))
        if isinstance(f.dataType, StructType):
            out.extend(flatten_fields(f.dataType, prefix=f"{path}."))
    return out


def all_nullable(schema: StructType) -> StructType:
    def relax(dt: DataType) -> DataType:
        if isinstance(dt, StructType):
            return StructType([StructField(f.name, relax(f.dataType), True) for f in dt.fields])
        if isinstance(dt, ArrayType):
            return ArrayType(relax(dt.elementType), True)
        if isinstance(dt, MapType):
            return MapType(dt.keyType, relax(dt.valueType), True)
        return dt

    return relax(schema)
