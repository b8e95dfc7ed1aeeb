"""Previews and profiles; each is one pass with partial aggregation."""

from __future__ import annotations

import warnings
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import CursorRefused
from tidemark.functions.cursors import column, cursor_type
from tidemark.functions.frames import small_frame

_COLUMNS = T.StructType(
    [T.StructField("ordinal", T.IntegerType()), T.StructField("column_name", T.StringType())]
)
_SHAPES = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        T.StructField("n_cols", T.IntegerType()),
        T.StructField("n", T.LongType()),
    ]
)


def preview_head(df: DataFrame, key: str | list[str], n: int = 5) -> DataFrame:
    """The first rows by a key: a top-n per task, then of those; no full sort."""
    keys = [key] if isinstance(key, str) else key
    return df.orderBy(*(column(k) for k in keys)).limit(n)


def profile_info(df: DataFrame) -> DataFrame:
    """Per column: position, name, type, rows and non-null values."""
    fields = df.schema.fields
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *(F.count(column(f.name)).alias(f"c{i}") for i, f in enumerate(fields, 1)),
    )
    lines = F.array(
        *(
            F.struct(
                F.lit(i).alias("ordinal"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("dtype"),
                F.col(f"c{i}").alias("n_non_null"),
            )
            for i, f in enumerate(fields, 1)
        )
    )
    return counts.select("n_rows", F.inline(lines)).select(
        "ordinal", "column_name", "dtype", "n_rows", "n_non_null"
    )


def stream_shape(df: DataFrame, stream: str) -> DataFrame:
    """Rows and columns; on Parquet the count needs only footers."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(stream).alias("stream"),
        "n_rows",
        F.lit(len(df.columns)).alias("n_cols"),
    )


def stream_shapes(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns of many streams: all scans in one stage, one exchange."""
    spark = next(iter(frames.values())).sparkSession
    one = F.lit(1).cast("bigint").alias("n")
    # A line of weight zero keeps streams without rows.
    lines = small_frame(
        spark, [(name, len(df.columns), 0) for name, df in frames.items()], _SHAPES
    )
    for name, df in frames.items():
        width = F.lit(len(df.columns)).alias("n_cols")
        lines = lines.union(df.select(F.lit(name).alias("stream"), width, one))
    return lines.groupBy("stream", "n_cols").agg(F.sum("n").alias("n_rows"))


def column_list(df: DataFrame) -> DataFrame:
    """Column names in order, from the schema alone."""
    rows = [(i, name) for i, name in enumerate(df.columns, 1)]
    return small_frame(df.sparkSession, rows, _COLUMNS)


def cursor_profile(df: DataFrame, cursor: str) -> DataFrame:
    """What decides whether a column can be a cursor: NULLs, ties, range.

    ``n_ties`` is the number of rows beyond the first of each value. NaN sorts
    above every number and would end all later syncs, so it counts as unset.
    """
    dtype, at = cursor_type(df, cursor), column(cursor)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        at = F.when(~F.isnan(at), at)
    return df.select(at.alias("c")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        (F.count(F.lit(1)) - F.count("c")).alias("n_unset"),
        F.count_distinct("c").alias("n_distinct"),
        (F.count("c") - F.count_distinct("c")).alias("n_ties"),
        F.min("c").alias("min_value"),
        F.max("c").alias("max_value"),
    )


def require_cursor(df: DataFrame, cursor: str) -> None:
    """Refuse a cursor with NULL or NaN values; warn of one with ties."""
    found = cursor_profile(df, cursor).first()
    if found["n_unset"]:
        raise CursorRefused(
            f"{cursor!r} is unset in {found['n_unset']} rows; only a full sync sees them"
        )
    if found["n_ties"]:
        warnings.warn(
            f"{cursor!r} has {found['n_ties']} ties; sync with inclusive=True, or late"
            " rows at the last value are missed",
            stacklevel=2,
        )
