"""Schemas compared and widened by column name; failures name the column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.cursors import column


def shape_of(schema: T.StructType) -> dict[str, str]:
    """Column name to type, without nullability or order."""
    return {f.name: f.dataType.simpleString() for f in schema.fields}


def differences(left: T.StructType, right: T.StructType) -> list[str]:
    """One line per column that is missing on a side or differs in type."""
    a, b = shape_of(left), shape_of(right)
    return [
        f"{name}: {a.get(name, 'absent')} against {b.get(name, 'absent')}"
        for name in sorted(a.keys() | b.keys())
        if a.get(name) != b.get(name)
    ]


def nullable(schema: T.StructType) -> T.StructType:
    """The schema as a Parquet reader reports it: every column nullable."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


# Digits of the whole numbers.
_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


def widens(old: T.DataType, new: T.DataType) -> bool:
    """Whether every value of ``old`` is also one of ``new``, as a cast gives it."""
    a, b = old.simpleString(), new.simpleString()
    if a == b:
        return True
    if a in _DIGITS and b in _DIGITS:
        return _DIGITS[a] < _DIGITS[b]
    if isinstance(new, T.DecimalType):
        whole = new.precision - new.scale
        if isinstance(old, T.DecimalType):
            return old.scale <= new.scale and old.precision - old.scale <= whole
        return _DIGITS.get(a, 39) <= whole
    if b == "double":
        return a in ("float", "tinyint", "smallint", "int")
    return (a, b) == ("date", "timestamp_ntz")


def narrowings(old: T.StructType, new: T.StructType) -> list[str]:
    """One line per column that ``new`` lacks, or whose values it cannot all hold."""
    after = {f.name: f.dataType for f in new.fields}
    return [
        f"{f.name}: {f.dataType.simpleString()} against"
        f" {after[f.name].simpleString() if f.name in after else 'absent'}"
        for f in sorted(old.fields, key=lambda f: f.name)
        if f.name not in after or not widens(f.dataType, after[f.name])
    ]


def as_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in a schema that widens its own: lacking columns are NULL."""
    have = {f.name: f.dataType for f in df.schema.fields}
    columns = []
    for f in schema.fields:
        at = column(f.name) if f.name in have else F.lit(None)
        if have.get(f.name) != f.dataType:
            at = at.cast(f.dataType).alias(f.name)
        columns.append(at)
    return df.select(*columns)
