"""JDBC reads, split so that every executor pulls its own share.

A plain JDBC read is one task. ``Stride`` lets Spark cut a numeric, date or
timestamp column into equal ranges; that is uneven when values cluster.
``Split`` carries explicit predicates that together match every row exactly
once: ``range_split`` over given cut points (``balanced_cuts`` finds equal-sized
ones from an earlier copy), ``key_split`` over the remainder of a nearly unique
key, which stays even when one range or one cursor value holds a large share of
the rows, or Oracle's ``rowid_split`` where no such key exists.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import JdbcSource
from tidemark.functions.cursors import column


@dataclass(frozen=True)
class Stride:
    """Equal-width ranges of a column; the bounds set the width and filter nothing."""

    column: str
    lower: object
    upper: object
    partitions: int


@dataclass(frozen=True)
class Split:
    """One predicate per task; every row must satisfy exactly one."""

    predicates: tuple[str, ...]

    def __post_init__(self):
        if not self.predicates:
            raise ValueError("no predicate would read no row")


class SqlLiteral(str):
    """Text that is already a SQL literal."""


def quoted(name: str) -> str:
    """A case-preserving identifier; needed for names that start with a digit."""
    return '"' + name.replace('"', '""') + '"'


def text_literal(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sql_literal(value) -> str:
    if isinstance(value, SqlLiteral):
        return str(value)
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, (int, float, Decimal)) and not isinstance(value, bool):
        return str(value)
    if isinstance(value, str):
        return text_literal(value)
    raise TypeError(f"no SQL literal for {value!r}")


def key_split(key: str, partitions: int) -> Split:
    """Rows by the remainder of an integer or decimal key; NULLs go with the first."""
    name = quoted(key)
    return Split(
        tuple(
            f"ABS(MOD(FLOOR({name}), {partitions})) = {i}"
            + ("" if i else f" OR {name} IS NULL")
            for i in range(partitions)
        )
    )


def rowid_split(partitions: int) -> Split:
    """Rows of an Oracle table by their address; even whatever the columns hold.

    For tables without a key that is nearly unique. Every task has the database
    look at all rows its filters leave, so ranges suit a full read better.
    """
    return Split(
        tuple(f"ORA_HASH(ROWID, {partitions - 1}) = {i}" for i in range(partitions))
    )


def range_split(key: str, cuts: Sequence) -> Split:
    """Rows by half-open ranges between cut points; NULLs go with the first."""
    plain = [c for c in cuts if not isinstance(c, SqlLiteral)]
    if any(a >= b for a, b in zip(plain, plain[1:], strict=False)):
        raise ValueError("cut points must strictly increase")
    name, cuts = quoted(key), [sql_literal(c) for c in cuts]
    if not cuts:
        return Split((f"{name} IS NULL OR {name} IS NOT NULL",))
    middle = (
        f"{name} >= {low} AND {name} < {high}"
        for low, high in zip(cuts, cuts[1:], strict=False)
    )
    return Split(
        (f"{name} < {cuts[0]} OR {name} IS NULL", *middle, f"{name} >= {cuts[-1]}")
    )


def balanced_cuts(df: DataFrame, key: str, partitions: int) -> list[SqlLiteral]:
    """Cut points that give about equal row counts, from an earlier copy of a table.

    The copy only steers the balance: with ``range_split`` every row is read once
    whatever the cuts are. A value so frequent that it fills several shares yields
    one cut; use ``key_split`` then.
    """
    dtype = df.schema[key].dataType
    if isinstance(dtype, T.DateType):
        wrap = "DATE '{}'"
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        wrap = "TIMESTAMP '{}'"
    elif isinstance(dtype, T.NumericType):
        wrap = "{}"
    else:
        raise TypeError(f"{key!r} is {dtype.simpleString()}; only numbers and times cut")
    shares = [F.lit(i / partitions) for i in range(1, partitions)]
    if not shares:
        return []
    cuts = F.percentile_approx(column(key), F.array(*shares), 10_000)
    found = df.agg(F.array_distinct(cuts).cast("array<string>").alias("cuts")).first()
    return [SqlLiteral(wrap.format(c)) for c in found["cuts"] or []]


def table_name(schema: str, stream: str) -> str:
    return f"{quoted(schema)}.{quoted(stream)}"


# Fixed value: where Oracle says its present system change number.
MOMENT = f"(SELECT DBMS_FLASHBACK.GET_SYSTEM_CHANGE_NUMBER AS {quoted('moment')} FROM DUAL) q"


def moment_of(spark: SparkSession, src: JdbcSource) -> int:
    """The database's system change number now; only Oracle has one."""
    if src.dictionary != "oracle":
        raise ValueError("only Oracle can be read as of one moment")
    return int(read_table(spark, src, MOMENT).first()["moment"])


def as_of(table: str, moment: int | None) -> str:
    """A table as it was at a system change number, whoever reads it and when."""
    return table if moment is None else f"{table} AS OF SCN {int(moment)}"


def _stride_bound(value) -> str:
    """Spark reads numeric bounds as whole numbers; they only set the width."""
    return str(math.floor(value) if isinstance(value, (float, Decimal)) else value)


def read_table(
    spark: SparkSession,
    src: JdbcSource,
    dbtable: str,
    partition: Stride | Split | None = None,
) -> DataFrame:
    """A table or parenthesised query as a DataFrame, one task per partition."""
    options = src.reader_options()
    if isinstance(partition, Split):
        url = options.pop("url")
        return spark.read.jdbc(
            url, dbtable, predicates=list(partition.predicates), properties=options
        )
    if isinstance(partition, Stride):
        options |= {
            "partitionColumn": partition.column,
            "lowerBound": _stride_bound(partition.lower),
            "upperBound": _stride_bound(partition.upper),
            "numPartitions": str(partition.partitions),
        }
    return (
        spark.read.format("jdbc").options(**options).option("dbtable", dbtable).load()
    )


def max_query(schema: str, stream: str, cursor: str, moment: int | None = None) -> str:
    """The cursor's maximum, computed by the database: one row crosses the wire."""
    table = as_of(table_name(schema, stream), moment)
    return f"(SELECT MAX({quoted(cursor)}) AS {quoted('mark')} FROM {table}) q"


def stride_query(schema: str, stream: str, key: str) -> str:
    name = quoted(key)
    return (
        f"(SELECT MIN({name}) AS {quoted('lower')}, MAX({name}) AS {quoted('upper')}"
        f" FROM {table_name(schema, stream)}) q"
    )


def stride_for(
    spark: SparkSession,
    src: JdbcSource,
    schema: str,
    stream: str,
    key: str,
    partitions: int,
) -> Stride | None:
    """A stride over the column's present range; None for an empty table."""
    found = read_table(spark, src, stride_query(schema, stream, key))
    lower, upper = F.col("lower"), F.col("upper")
    if isinstance(found.schema["lower"].dataType, T.NumericType):
        lower, upper = F.floor(lower), F.ceil(upper)
    row = found.select(
        lower.cast("string").alias("lower"), upper.cast("string").alias("upper")
    ).first()
    if row is None or row["lower"] is None:
        return None
    return Stride(key, row["lower"], row["upper"], partitions)


# The column dictionary of each database family.
_DICTIONARIES = {
    "oracle": (
        "ALL_TAB_COLUMNS",
        "OWNER",
        "TABLE_NAME",
        "COLUMN_ID",
        "COLUMN_NAME",
        "DATA_TYPE",
    ),
    "ansi": (
        "information_schema.columns",
        "table_schema",
        "table_name",
        "ordinal_position",
        "column_name",
        "data_type",
    ),
}


def dictionary_query(dictionary: str, schemas: Sequence[str]) -> str:
    """Columns of every visible table, the owner filter inside the database."""
    view, owner, table, position, name, dtype = _DICTIONARIES[dictionary]
    where = ""
    if schemas:
        where = f" WHERE {owner} IN ({', '.join(text_literal(s) for s in schemas)})"
    return (
        f"(SELECT {owner} AS {quoted('schema_name')}, {table} AS {quoted('stream')},"
        f" {position} AS {quoted('ordinal')}, {name} AS {quoted('column_name')},"
        f" {dtype} AS {quoted('dtype')} FROM {view}{where}) q"
    )
