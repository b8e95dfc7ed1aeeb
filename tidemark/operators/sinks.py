"""Landing a DataFrame as a Parquet snapshot, a table or CSV."""

from __future__ import annotations

import json
import warnings
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import SchemaDrift
from tidemark.functions.cursors import column
from tidemark.functions.schemas import differences, narrowings, nullable
from tidemark.operators import synclog
from tidemark.operators.snapshots import current
from tidemark.operators.synclog import FULL, INCREMENTAL, Commit
from tidemark.sources.lake import child_names

_LOOK_UP = object()


def land(
    df: DataFrame,
    root: str,
    stream: str,
    sync_ms: int | None = None,
    mode: str = FULL,
    cursor: str | None = None,
    hwm: str | None = None,
    max_records_per_file: int = 0,
    last=_LOOK_UP,
    key: Sequence[str] | None = None,
    before_commit: Callable[[Commit], None] | None = None,
) -> Commit:
    """Write a snapshot of a stream as SNAPPY Parquet and commit it.

    ``full`` replaces the stream's state, ``incremental`` adds to it. The data is
    written to a new folder and becomes visible with the log row; if the job dies
    between the two, the folder stays unread. Nothing is overwritten, so readers
    of the old state are not disturbed. Row counts come from the landed files,
    without a cursor from their footers alone, never from the source again.

    An increment may bring new columns, and types that hold all values of the old ones;
    a column that is missing or narrower fails by name. With ``key``, columns that name
    a row, an added row stands for all earlier ones of its key, see ``current``; a
    stream's increments keep the key it has.

    One task writes one file per partition of ``df``; ``max_records_per_file``
    cuts the file of an oversized one. ``before_commit`` is called between the data and
    the log row: what it writes is there once the commit is.
    """
    spark = df.sparkSession
    if mode not in (FULL, INCREMENTAL):
        raise ValueError(f"mode must be {FULL!r} or {INCREMENTAL!r}, not {mode!r}")
    if last is _LOOK_UP:
        last = synclog.last_commit(spark, root, stream)
    if mode == INCREMENTAL:
        if last is None:
            raise ValueError(f"{stream!r} has no full sync to add to")
        before = T.StructType.fromJson(json.loads(last["schema_json"]))
        if narrowings(before, df.schema):
            unlike = "; ".join(differences(before, df.schema))
            raise SchemaDrift(f"{stream!r} changed: {unlike}; do a full sync")
        had = json.loads(last["key_json"] or "null")
        if key is not None and had is not None and list(key) != had:
            raise ValueError(f"{stream!r} was synced by key {had}; do a full sync")
        key = had if key is None else key
    if key is not None:
        absent = [name for name in key if name not in df.columns]
        if absent or not key:
            raise ValueError(f"{stream!r} has no key columns {absent or list(key)}")
    sync_ms = synclog.next_sync_ms(last, sync_ms)
    path = synclog.snapshot_path(root, stream, sync_ms)
    df.write.mode("errorifexists").option("compression", "snappy").option(
        "maxRecordsPerFile", max_records_per_file
    ).parquet(path)
    landed = spark.read.schema(df.schema).parquet(path)
    given = F.count(column(cursor)) if cursor else F.count(F.lit(1))
    n_rows, n_set = landed.agg(F.count(F.lit(1)), given).first()
    if n_set < n_rows:
        warnings.warn(
            f"{stream!r}: rows with NULL {cursor!r} come only with a full sync",
            stacklevel=2,
        )
    commit = Commit(
        stream,
        sync_ms,
        mode,
        cursor,
        hwm,
        n_rows,
        nullable(df.schema).json(),
        full_ms=sync_ms if mode == FULL else last["full_ms"],
        key_json=None if key is None else json.dumps(list(key)),
    )
    if before_commit is not None:
        before_commit(commit)
    synclog.append(spark, root, commit)
    return commit


def delta_enabled(spark: SparkSession) -> bool:
    return "io.delta" in (spark.conf.get("spark.sql.extensions", "") or "")


def _is_delta(spark: SparkSession, root: str, table: str) -> bool:
    """A table is what its folder says it is, whatever this session can do.

    A new table becomes a Delta table where the session has that extension.
    """
    path, able = synclog.stream_path(root, table), delta_enabled(spark)
    if "_delta_log" in child_names(spark, path):
        if not able:
            raise ValueError(f"{table!r} is a Delta table; this session has no Delta")
        return True
    return able and synclog.last_commit(spark, root, table) is None


def write_table(df: DataFrame, root: str, table: str, mode: str = "overwrite") -> None:
    """Replace or extend a table under ``root``, in the format it has.

    A new one becomes a Delta table where the session has that extension, otherwise
    snapshots that ``current`` reads; both replace atomically. ``read_table`` reads
    either. A Delta table in a session without Delta fails by name.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be 'overwrite' or 'append', not {mode!r}")
    spark = df.sparkSession
    if _is_delta(spark, root, table):
        path = synclog.stream_path(root, table)
        df.write.format("delta").mode(mode).save(path)
        return
    last = synclog.last_commit(spark, root, table)
    adds = mode == "append" and last is not None
    land(df, root, table, mode=INCREMENTAL if adds else FULL, last=last)


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """What ``write_table`` wrote."""
    if _is_delta(spark, root, table):
        return spark.read.format("delta").load(synclog.stream_path(root, table))
    return current(spark, root, table)


BOM = "\ufeff"
_NEVER = "\uffff"  # no character of any text
_TIME = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
# JSON's own defaults drop microseconds and NULL fields.
_JSON = {
    "timestampFormat": _TIME + "xxx",
    "timestampNTZFormat": _TIME,
    "ignoreNullFields": "false",
}


_NESTED = (T.ArrayType, T.MapType, T.StructType)


def _as_text(field: T.StructField) -> Column:
    """Nested and binary values as text, others as they are."""
    value = column(field.name)
    if isinstance(field.dataType, _NESTED):
        return F.to_json(value, _JSON)
    return F.base64(value) if isinstance(field.dataType, T.BinaryType) else value


def _from_text(field: T.StructField) -> Column:
    """The inverse of ``_as_text``."""
    value = column(field.name)
    if isinstance(field.dataType, _NESTED):
        if _odd_keys(field.dataType):
            raise ValueError(f"{field.name!r}: maps are read back from CSV by text keys only")
        value = F.from_json(value, field.dataType, _JSON | {"mode": "FAILFAST"})
    elif isinstance(field.dataType, T.BinaryType):
        value = F.unbase64(value)
    return value.alias(field.name)


def _odd_keys(kind: T.DataType) -> bool:
    if isinstance(kind, T.MapType):
        return not isinstance(kind.keyType, T.StringType) or _odd_keys(kind.valueType)
    if isinstance(kind, T.ArrayType):
        return _odd_keys(kind.elementType)
    return isinstance(kind, T.StructType) and any(_odd_keys(f.dataType) for f in kind)


def write_csv(
    df: DataFrame,
    path: str,
    bom: bool = True,
    single_file: bool = False,
    max_records_per_file: int = 1_000_000,
) -> None:
    """A folder of CSV files, each with a header and, by default, a UTF-8 BOM.

    NULL and the empty string are both written empty; quotes are doubled; blanks
    around values stay. Nested columns are written as JSON, binary values in Base64,
    instants with their offset, so that a session in another zone reads the same ones.
    Maps need text keys to be read back. A file is read back by one task, so long ones
    are cut. ``single_file`` sends all rows through one task
    and is meant for small results.
    """
    # A lone empty value would make a blank line, which readers skip.
    empty = '""' if len(df.columns) == 1 else ""
    fields = [
        _as_text(f).alias(BOM + f.name if bom and i == 0 else f.name)
        for i, f in enumerate(df.schema.fields)
    ]
    out = df.select(*fields)
    if single_file:
        out, max_records_per_file = out.coalesce(1), 0
    (
        out.write.mode("errorifexists")
        .option("maxRecordsPerFile", max_records_per_file)
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("escape", '"')
        # The writer would quote a leading "#" as if it began a comment.
        .option("comment", _NEVER)
        .option("emptyValue", empty)
        .option("nullValue", empty)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("timestampFormat", _TIME + "xxx")
        .option("timestampNTZFormat", _TIME)
        .csv(path)
    )


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Read what ``write_csv`` wrote; empty values come back as NULL.

    Values may hold line breaks, so a file is one task: the writer's partitions
    set the parallelism.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    coded = (*_NESTED, T.BinaryType)
    plain = T.StructType(
        [
            T.StructField(f.name, T.StringType() if isinstance(f.dataType, coded) else f.dataType)
            for f in schema
        ]
    )
    rows = (
        spark.read.schema(plain)
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("escape", '"')
        # With the default, zero characters in quoted values are lost.
        .option("charToEscapeQuoteEscaping", _NEVER)
        .option("multiLine", True)
        .option("timestampFormat", _TIME + "xxx")
        .option("timestampNTZFormat", _TIME)
        .option("mode", "FAILFAST")
        .csv(path)
    )
    return rows if plain == schema else rows.select(*map(_from_text, schema))
