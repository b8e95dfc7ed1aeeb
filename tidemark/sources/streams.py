"""Full and incremental reads of one stream, from a database or a lake."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import JdbcSource, Source
from tidemark.errors import NoData, UnknownStream
from tidemark.functions.cursors import (
    beyond,
    bound,
    column,
    cursor_type,
    from_text,
    to_text,
    upto,
    within,
)
from tidemark.functions.frames import small_frame
from tidemark.operators.multiset import subtract_all
from tidemark.sources import jdbc
from tidemark.sources.lake import file_system_path, read_lake
from tidemark.sources.listing import footers, opener


def owner(src: Source, schema: str | None) -> str:
    """The schema a stream lives in; only one-schema sources need not name it."""
    if schema is not None:
        return schema
    if len(src.schemas) != 1:
        raise ValueError(f"name the schema: the source has {list(src.schemas)}")
    return src.schemas[0]


def read_stream(
    spark: SparkSession,
    src: Source,
    stream: str,
    partition: jdbc.Stride | jdbc.Split | None = None,
    schema: str | None = None,
    moment: int | None = None,
) -> DataFrame:
    """All rows and columns of a stream.

    Column pruning and filters put on the result reach the scan on both kinds of
    source. ``partition`` splits a JDBC read; Parquet splits by file blocks. With
    ``moment``, an Oracle system change number, all parts of the split see the table as
    it was then.
    """
    schema = owner(src, schema)
    if isinstance(src, JdbcSource):
        table = jdbc.as_of(jdbc.table_name(schema, stream), moment)
        return jdbc.read_table(spark, src, table, partition)
    try:
        return read_lake(spark, src.path(schema, stream))
    except NoData as error:
        raise UnknownStream(f"no stream {stream!r} in schema {schema!r}") from error


def read_streams(
    spark: SparkSession, src: Source, streams: Iterable[str], schema: str | None = None
) -> dict[str, DataFrame]:
    """Several streams by name; their schemas are looked up side by side."""
    names = list(streams)
    with ThreadPoolExecutor(8) as pool:
        frames = pool.map(lambda n: read_stream(spark, src, n, schema=schema), names)
        return dict(zip(names, frames, strict=True))


def high_water_mark(df: DataFrame, cursor: str) -> DataFrame:
    """One row: the cursor's maximum and the number of rows."""
    return df.agg(
        F.max(column(cursor)).alias("hwm"), F.count(F.lit(1)).alias("n_rows")
    )


def stream_mark(
    spark: SparkSession, src: Source, stream: str, cursor: str, schema: str | None = None
) -> DataFrame:
    """``high_water_mark`` of a stream, from the footers of its files where they tell:
    of whole numbers, dates and times. No column is read then."""
    df = read_stream(spark, src, stream, schema=schema)
    dtype = cursor_type(df, cursor)
    told = None if isinstance(src, JdbcSource) else _from_footers(spark, df, cursor, dtype)
    if told is None:
        return high_water_mark(df, cursor)
    mark, n_rows = told
    value = F.lit(None).cast(dtype) if mark is None else from_text(mark, dtype)
    return spark.range(0, 1, 1, 1).select(
        value.alias("hwm"), F.lit(n_rows).cast("bigint").alias("n_rows")
    )


def _from_footers(
    spark: SparkSession, df: DataFrame, cursor: str, dtype: T.DataType
) -> tuple[str | None, int] | None:
    """The cursor's maximum, as log text, and the rows, of the very files ``df`` reads;
    None where footers do not tell.

    Tasks read the footers. Text and decimals may be cut off there, and NaN is left out,
    so only whole numbers, dates and times count; and only if each row group tells.
    """
    if not isinstance(dtype, (T.IntegralType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return None
    names = df.inputFiles()
    how = opener(spark, names[0]) if names else None
    if how is None:
        return None
    paths = [(file_system_path(unquote(name)),) for name in names]
    files = small_frame(spark, paths, T.StructType([T.StructField("path", T.StringType())]))
    most = F.expr(
        "CASE unit WHEN 'ms' THEN 1000 * most WHEN 'ns' THEN floor(most / 1000) ELSE most END"
    )
    mine = F.col("column_name") == cursor
    found = (
        footers(spark, how, files, column=cursor)
        .agg(
            F.max(F.when(mine, most)).alias("most"),
            F.count_if(mine).alias("n_files"),
            F.count_if(F.col("problem").isNotNull() | (mine & ~F.col("complete"))).alias("n_mute"),
            F.sum(F.when(F.coalesce("position", F.lit(0)) == 0, F.col("n_rows"))).alias("n_rows"),
        )
        .first()
    )
    if found["n_mute"] or not found["n_files"]:
        return None
    value = found["most"]
    if value is None or isinstance(dtype, (T.IntegralType, T.TimestampType)):
        return None if value is None else str(value), found["n_rows"]
    if isinstance(dtype, T.DateType):
        return str(date(1970, 1, 1) + timedelta(days=value)), found["n_rows"]
    return str(datetime(1970, 1, 1) + timedelta(microseconds=value)), found["n_rows"]


def source_mark(
    spark: SparkSession,
    src: Source,
    stream: str,
    cursor: str,
    schema: str | None = None,
    above: str | None = None,
    df: DataFrame | None = None,
    moment: int | None = None,
) -> str | None:
    """The cursor's maximum now, as log text; None when there is no such value.

    With ``above`` only a greater value counts. A database computes the maximum
    itself. On a lake the footers tell it, where they can; else ``above`` limits the scan
    to row groups that can hold one. ``df`` is the stream where the caller has read it already.
    """
    if df is None:
        df = read_stream(spark, src, stream, schema=schema)
    dtype = cursor_type(df, cursor)
    if isinstance(src, JdbcSource):
        query = jdbc.max_query(owner(src, schema), stream, cursor, moment)
        found = jdbc.read_table(spark, src, query)
        # MAX may come back wider than the column it was taken from.
        found = found.select(F.col("mark").cast(dtype))
        if above is not None:
            found = found.filter(beyond(F.col("mark"), from_text(above, dtype), dtype))
    elif (told := _from_footers(spark, df, cursor, dtype)) is not None:
        if told[0] is None:
            return None
        found = spark.range(0, 1, 1, 1).select(from_text(told[0], dtype).alias("mark"))
        if above is not None:
            found = found.filter(beyond(F.col("mark"), from_text(above, dtype), dtype))
    else:
        if above is not None:
            df = df.filter(beyond(column(cursor), from_text(above, dtype), dtype))
        found = df.agg(F.max(column(cursor)).alias("mark"))
    row = found.select(to_text(F.col("mark"), dtype).alias("mark")).first()
    return row["mark"] if row else None


def newer_rows(
    df: DataFrame,
    cursor: str,
    lo,
    hi,
    inclusive: bool = False,
    landed: DataFrame | None = None,
) -> DataFrame:
    """Rows of ``df`` with ``lo < cursor <= hi``, see ``read_incremental``."""
    dtype, at = cursor_type(df, cursor), column(cursor)
    in_time = upto(at, bound(hi, dtype), dtype)
    if lo is None:
        return df.filter(in_time)
    lo = bound(lo, dtype)
    newer = df.filter(beyond(at, lo, dtype) & in_time)
    if not inclusive:
        return newer
    if landed is None:
        raise ValueError("inclusive needs the rows landed so far")
    tied = within(at, lo, dtype)
    return newer.unionByName(subtract_all(df.filter(tied), landed.filter(at == lo)))


def read_incremental(
    spark: SparkSession,
    src: Source,
    stream: str,
    cursor: str,
    lo=None,
    hi=None,
    inclusive: bool = False,
    landed: DataFrame | None = None,
    partition: jdbc.Stride | jdbc.Split | None = None,
    schema: str | None = None,
) -> DataFrame:
    """Rows with ``lo < cursor <= hi``; ``hi`` is the source's maximum if not given.

    ``hi`` is fixed before the rows are read, so rows that arrive meanwhile are
    left to the next read. Rows with a NULL cursor come only with a full read, and
    updates or deletes that do not move the cursor are not seen. Where a database holds
    finer values than Spark's type, a bound stands for all values that Spark reads as it.

    A row may arrive late with a cursor value already seen. ``inclusive=True``
    also takes the rows at ``lo`` that ``landed`` does not hold yet, copies counted.
    """
    df = read_stream(spark, src, stream, partition, schema)
    if hi is None:
        mark = source_mark(spark, src, stream, cursor, schema, df=df)
        if mark is None:
            return df.filter(F.lit(False))
        hi = from_text(mark, cursor_type(df, cursor))
    return newer_rows(df, cursor, lo, hi, inclusive, landed)
