"""Hashes of rows, nested values included."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.cursors import column


def row_hash(df: DataFrame, seed: int = 1) -> Column:
    """A 64-bit hash of a row of ``df``, from the hashes of its columns."""
    return F.xxhash64(F.lit(seed), *(hashed(column(f.name), f.dataType, seed) for f in df.schema))


def hashed(value: Column, kind: T.DataType, seed: int) -> Column:
    """A hash that is never NULL and tells apart what is nested: hashing a nested value
    itself runs over its parts without their bounds and skips those that are NULL."""
    unset, start = value.isNull(), F.lit(seed)
    if isinstance(kind, T.ArrayType):
        inner = F.transform(value, lambda x: hashed(x, kind.elementType, seed))
        return F.xxhash64(start, unset, F.size(value), inner)
    if isinstance(kind, T.MapType):
        entries = F.transform(
            F.map_entries(value),
            lambda x: F.xxhash64(
                start,
                hashed(x["key"], kind.keyType, seed),
                hashed(x["value"], kind.valueType, seed),
            ),
        )
        return F.xxhash64(start, unset, F.size(value), F.array_sort(entries))
    if isinstance(kind, T.StructType):
        # an outer NULL makes every field NULL, so its own flag tells the two apart
        fields = [hashed(value.getField(f.name), f.dataType, seed) for f in kind.fields]
        return F.xxhash64(start, unset, *fields)
    return F.xxhash64(start, unset, value)
