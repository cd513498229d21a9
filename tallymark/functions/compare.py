"""Comparing the values of two sides of a reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructField, StructType


def values_match(left: Column, right: Column, tolerance: float = 0.0) -> Column:
    """Equal, both NULL, or at most ``tolerance`` apart. Never NULL itself.

    NULL-safe equality comes first because the distance to a NULL is NULL.
    """
    equal = left.eqNullSafe(right)
    if not tolerance:
        return equal
    return equal | F.coalesce(F.abs(left - right) <= F.lit(tolerance), F.lit(False))


def changed_columns(pairs: Mapping[str, tuple[Column, Column]], tolerances: Mapping[str, float]) -> Column:
    """Array with the names of the columns whose two values do not match."""
    return F.array_compact(
        F.array(
            *(
                F.when(~values_match(left, right, tolerances.get(name, 0.0)), F.lit(name))
                for name, (left, right) in pairs.items()
            )
        )
    )


def row_fingerprint(schema: StructType, columns: Sequence[str], seed: int = 0) -> Column:
    """64-bit hash of the named columns of a row of ``schema``.

    Spark's hash skips NULLs, so (NULL, 1) and (1, NULL) would collide, inside arrays and structs as well, and it does not
    see where one nested array ends. So the NULL pattern of the columns is hashed too, and nested values level by level.
    """
    nulls = [F.col(f"`{c}`").isNull() for c in columns]
    return F.xxhash64(F.lit(seed), *nulls, *(_hashable(F.col(f"`{c}`"), schema[c].dataType, seed) for c in columns))


def holds_map(kind: DataType) -> bool:
    """Whether values of this type are or contain maps, which Spark does not compare."""
    if isinstance(kind, MapType):
        return True
    if isinstance(kind, ArrayType):
        return holds_map(kind.elementType)
    return isinstance(kind, StructType) and any(holds_map(f.dataType) for f in kind)


def comparable(value: Column, kind: DataType) -> Column:
    """``value`` with every map in it, at any depth, as the sorted array of its entries: maps are equal if these are."""
    if not holds_map(kind):
        return value
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: comparable(x, kind.elementType))
    if isinstance(kind, StructType):
        parts = (comparable(value.getField(f.name), f.dataType).alias(f.name) for f in kind)
        return F.when(value.isNotNull(), F.struct(*parts))
    entry = StructType([StructField("key", kind.keyType), StructField("value", kind.valueType)])
    return F.array_sort(F.transform(F.map_entries(value), lambda x: comparable(x, entry)))


def _hashable(value: Column, kind: DataType, seed: int) -> Column:
    """``value`` itself, or for a nested one a text of hashes in which NULLs, borders and sizes show."""
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: _one(x, kind.elementType, seed)).cast("string")
    if isinstance(kind, StructType):
        parts = (_one(value.getField(f.name), f.dataType, seed) for f in kind)
        return F.when(value.isNotNull(), F.array(*parts).cast("string"))
    if isinstance(kind, MapType):
        entry = StructType([StructField("key", kind.keyType), StructField("value", kind.valueType)])
        entries = F.transform(F.map_entries(value), lambda x: _one(x, entry, seed))
        return F.array_sort(entries).cast("string")
    return value


def _one(value: Column, kind: DataType, seed: int) -> Column:
    """Hash of one value inside another; a NULL has none."""
    return F.when(value.isNotNull(), F.xxhash64(F.lit(seed), _hashable(value, kind, seed)))
