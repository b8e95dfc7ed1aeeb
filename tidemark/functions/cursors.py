"""Typed cursor bounds, and their text form in the sync log."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal, localcontext

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import CursorRefused

_ORDERED = (
    T.NumericType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
    T.StringType,
)


def column(name: str) -> Column:
    """A top-level column by its exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def cursor_type(df: DataFrame, cursor: str) -> T.DataType:
    """The cursor's type; refused when it has no order a bound can use."""
    if cursor not in df.columns:
        raise CursorRefused(f"no column {cursor!r} among {df.columns}")
    dtype = df.schema[cursor].dataType
    if not isinstance(dtype, _ORDERED):
        raise CursorRefused(f"{cursor!r} is {dtype.simpleString()}, which has no order")
    return dtype


def _literal(text: str, dtype: T.DataType) -> Column:
    """Text as a literal of a type; unreadable text fails in either ANSI mode.

    Without ANSI the cast alone would give NULL, and a filter on that no rows.
    """
    refused = F.raise_error(F.lit(f"{text!r} is no {dtype.simpleString()}"))
    return F.coalesce(F.lit(text).cast(dtype), refused.cast(dtype))


def bound(value, dtype: T.DataType) -> Column:
    """A literal of the cursor's own type, so that the comparison can be pushed."""
    if isinstance(value, Column):
        return value
    if isinstance(value, datetime):
        if value.tzinfo and isinstance(dtype, T.TimestampNTZType):
            raise CursorRefused(f"{value} has a zone, the cursor has none")
        value = value.isoformat(sep=" ")
    elif isinstance(value, float):
        if value != value:
            raise CursorRefused("NaN bounds nothing")
        value = repr(value)
    elif not isinstance(value, (str, int, Decimal, date)) or isinstance(value, bool):
        raise CursorRefused(f"cannot compare a cursor with {value!r}")
    return _literal(str(value), dtype)


def to_text(value: Column, dtype: T.DataType) -> Column:
    """A cursor value as log text, exact and independent of the session zone."""
    if isinstance(dtype, T.TimestampType):
        value = F.unix_micros(value)
    return value.cast("string")


def from_text(text: str, dtype: T.DataType) -> Column:
    """The inverse of ``to_text``."""
    if isinstance(dtype, T.TimestampType):
        return F.timestamp_micros(F.lit(int(text)))
    if text == "NaN":
        raise CursorRefused("the cursor's maximum is NaN, which bounds nothing")
    return _literal(text, dtype)


def _next(value: Column, dtype: T.DataType) -> Column | None:
    """The next value the type can hold; None where it ends, and for other types."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return value + F.expr("interval 1 microsecond")
    if not isinstance(dtype, T.DecimalType):
        return None
    # Spark's own sum of 38 digits would lose the last one.
    spark = SparkSession.active()
    known = spark.range(0, 1, 1, 1).select(value.cast(dtype)).first()[0]
    if known is None:
        return None
    with localcontext(prec=60):
        after = known + Decimal(1).scaleb(-dtype.scale)
        if after.scaleb(dtype.scale) >= Decimal(10) ** dtype.precision:
            return None
    return F.lit(str(after)).cast(dtype)


def upto(at: Column, mark: Column, dtype: T.DataType) -> Column:
    """``at <= mark``, also where ``at`` is evaluated by a database.

    A database may hold times and numbers finer than Spark's type, and compares those;
    a mark has lost the rest. Everything below the next mark is therefore taken.
    """
    after = _next(mark, dtype)
    return at <= mark if after is None else at < after


def beyond(at: Column, mark: Column, dtype: T.DataType) -> Column:
    """The rows that ``upto`` leaves, NULLs aside."""
    after = _next(mark, dtype)
    return at > mark if after is None else at >= after


def within(at: Column, mark: Column, dtype: T.DataType) -> Column:
    """``at == mark`` as Spark sees it: from the mark up to the next."""
    after = _next(mark, dtype)
    return at == mark if after is None else (at >= mark) & (at < after)
