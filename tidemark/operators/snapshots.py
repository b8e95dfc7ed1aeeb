"""Reading landed snapshots: present state, newest sync, history.

Readers take the exact folders that the log names. Spark then lists only those,
however many older snapshots lie beside them. What the driver holds is one number
per sync, less than the file listing any scan keeps there.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import NoData, SchemaDrift
from tidemark.functions.cursors import column
from tidemark.functions.frames import empty_frame
from tidemark.functions.hashes import row_hash
from tidemark.functions.keys import sync_epoch, utc_time
from tidemark.functions.schemas import as_schema, narrowings
from tidemark.operators import synclog
from tidemark.sources.lake import list_objects, read_lake

# Syncs that say what the stream held: those with rows, and full ones.
_TELLS = f"n_rows > 0 OR mode = '{synclog.FULL}'"
_DATED = "[0-9][0-9][0-9][0-9]_[0-9][0-9]_[0-9][0-9]"


def _read(
    spark: SparkSession,
    root: str,
    stream: str,
    sync_ids: list[int],
    schema: T.StructType,
    with_sync_ms: bool,
) -> DataFrame:
    full = schema
    if with_sync_ms:
        full = T.StructType([*schema.fields, T.StructField("sync_ms", T.LongType())])
    if not sync_ids:
        return empty_frame(spark, full)
    reader = spark.read.schema(full)
    if with_sync_ms:
        reader = reader.option("basePath", synclog.stream_path(root, stream))
    return reader.parquet(*(synclog.snapshot_path(root, stream, s) for s in sync_ids))


def _widest(stream: str, schemas: list[tuple[int, T.StructType]]) -> T.StructType:
    """The schema that holds the rows of all syncs, from the first to the last; a sync
    that would narrow it is named."""
    first_ms, widest = schemas[0]
    for sync_ms, schema in schemas[1:]:
        unlike = narrowings(widest, schema)
        if unlike and narrowings(schema, widest):
            raise SchemaDrift(
                f"{stream!r}: sync {first_ms} against {sync_ms}: {'; '.join(unlike)}"
            )
        if not unlike:
            widest = schema
    return widest


def current(
    spark: SparkSession, root: str, stream: str, with_sync_ms: bool = False
) -> DataFrame:
    """The stream's present rows: its last full sync and what was added since.

    A snapshot with fewer columns or narrower types than later ones is read by its own
    schema and widened. Where the stream has a key, an added row stands for all earlier
    rows of its key, see ``_last_versions``; without one, an updated row is there twice.
    """
    filled = F.when(F.col("n_rows") > 0, F.col("sync_ms"))
    rows = (  # one per distinct schema
        synclog.live(spark, root, stream)
        .groupBy("schema_json")
        .agg(
            F.min("sync_ms").alias("first_ms"),
            F.collect_list(filled).alias("filled"),
            F.min("full_ms").alias("full_ms"),
            F.max_by(F.struct("key_json", "cursor"), "sync_ms").alias("last"),
            F.max("sync_ms").alias("last_ms"),
        )
        .orderBy("first_ms")
        .collect()
    )
    if not rows:
        raise NoData(f"no committed sync of {stream!r} under {root}")
    schemas = [T.StructType.fromJson(json.loads(r["schema_json"])) for r in rows]
    firsts = [r["first_ms"] for r in rows]
    widest = _widest(stream, list(zip(firsts, schemas, strict=True)))
    last = max(rows, key=lambda r: r["last_ms"])["last"]
    full_ms = rows[0]["full_ms"]

    def read(wanted: Callable[[int], bool], with_ms: bool) -> DataFrame:
        to = T.StructType([*widest.fields, T.StructField("sync_ms", T.LongType())])
        parts = []
        for row, schema in zip(rows, schemas, strict=True):
            ids = sorted(filter(wanted, row["filled"]))
            if ids:
                part = _read(spark, root, stream, ids, schema, with_ms)
                same = schema.fields == widest.fields
                parts.append(part if same else as_schema(part, to if with_ms else widest))
        return reduce(DataFrame.unionByName, parts) if parts else empty_frame(
            spark, to if with_ms else widest
        )

    if not last["key_json"]:
        return read(lambda ms: True, with_sync_ms)
    found = _last_versions(
        read(lambda ms: ms == full_ms, True),
        read(lambda ms: ms != full_ms, True),
        json.loads(last["key_json"]),
        last["cursor"],
    )
    return found if with_sync_ms else found.select(*(column(c) for c in widest.names))


def _last_versions(
    full: DataFrame, added: DataFrame, key: list[str], cursor: str | None
) -> DataFrame:
    """Rows of a full sync that no added row stands for, and of each key's added rows the
    one with the greatest cursor, of equal ones that of the latest sync.

    Rows with a NULL in their key name nothing: they stand for themselves alone. Two rows
    of one sync with the same key and cursor are versions nobody can order; the one with
    the greater hash stays, at every read the same. Only the added rows are grouped, a
    partial result per key first, so a key with very many versions is no burden; of the
    full sync's rows, Spark compares the keys with those added, which it broadcasts where
    they are few.
    """
    names = [column(k) for k in key]
    keyed = reduce(lambda a, b: a & b, (c.isNotNull() for c in names))
    row = F.struct(*(column(c) for c in added.columns))
    order = [column(cursor)] if cursor else []
    order = F.struct(*order, column("sync_ms"), row_hash(added))
    newest = added.filter(keyed).groupBy(*names).agg(F.max_by(row, order).alias("__row"))
    newest = newest.select("__row.*")
    added_keys = added.filter(keyed).select(*names).distinct()
    kept = full.join(added_keys, key, "left_anti").select(*(column(c) for c in full.columns))
    return kept.unionByName(newest).unionByName(added.filter(~keyed))


def latest_snapshot(spark: SparkSession, root: str, stream: str) -> DataFrame:
    """The rows of the newest committed sync that landed any, or of a full sync that
    found the source empty."""
    log = synclog.live(spark, root, stream).filter(_TELLS)
    last = log.orderBy(F.desc("sync_ms")).first()
    if last is None:
        raise NoData(f"no committed sync of {stream!r} under {root}")
    schema = T.StructType.fromJson(json.loads(last["schema_json"]))
    sync_ids = [last["sync_ms"]] if last["n_rows"] else []
    return _read(spark, root, stream, sync_ids, schema, False)


def snapshot_history(
    spark: SparkSession, root: str, stream: str, recount: bool = False
) -> DataFrame:
    """Rows per sync that landed any, or was full, with the sync's UTC time.

    The log has the counts taken at the commit; ``recount`` takes them anew from
    the footers of all snapshots.
    """
    log = synclog.committed(spark, root, stream).filter(_TELLS)
    counts = log.select("sync_ms", "n_rows")
    if recount:
        sync_ids = sorted(r["sync_ms"] for r in counts.filter("n_rows > 0").collect())
        rows = _read(spark, root, stream, sync_ids, T.StructType(), True)
        found = rows.groupBy("sync_ms").agg(F.count(F.lit(1)).alias("found"))
        counts = counts.join(found, "sync_ms", "left").select(
            "sync_ms", F.coalesce("found", F.lit(0).cast("bigint")).alias("n_rows")
        )
    return counts.select("sync_ms", utc_time("sync_ms").alias("synced_at"), "n_rows")


def _sync_files(spark: SparkSession, folder: str) -> DataFrame:
    """Sync files right in the folder; names with a slash lie deeper and fit no pattern."""
    return (
        list_objects(spark, folder, glob="*_*_*.parquet")
        .select(sync_epoch("object_name").alias("sync_ms"), "length")
        .filter(F.col("sync_ms").isNotNull())
    )


def latest_sync_files(spark: SparkSession, folder: str) -> DataFrame:
    """The newest sync in a folder of ``<yyyy_mm_dd>_<epoch ms>_<part>.parquet`` files.

    The epoch comes from file names; then only that sync's files, all parts of
    them, are read, so older files with another schema do no harm. Parts that
    disagree on a column's type fail by name.
    """
    newest = _sync_files(spark, folder).agg(F.max("sync_ms")).first()[0]
    if newest is None:
        raise NoData(f"no sync file in {folder}")
    parts = read_lake(spark, folder, f"{_DATED}_{newest}_*.parquet")
    return parts.filter(sync_epoch(F.col("_metadata.file_name")) == newest)


def sync_file_history(spark: SparkSession, folder: str) -> DataFrame:
    """Files, bytes and UTC time per sync of such a folder, from the listing alone."""
    return (
        _sync_files(spark, folder)
        .groupBy("sync_ms")
        .agg(
            utc_time("sync_ms").alias("synced_at"),
            F.count(F.lit(1)).alias("n_files"),
            F.sum("length").alias("n_bytes"),
        )
    )


def read_back(spark: SparkSession, folder: str, key: str = "") -> DataFrame:
    """A named sync file, or the newest sync where none is named."""
    return read_lake(spark, folder, key) if key else latest_sync_files(spark, folder)
