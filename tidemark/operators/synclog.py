"""The commit log: a snapshot exists for readers once its row is here.

Layout under a lake root::

    <root>/<stream>/sync_ms=<epoch ms>/part-*.parquet         immutable snapshots
    <root>/_sync_log/<stream>/<full ms>/<epoch ms>/           one row per commit
    <root>/_sync_log/<stream>/failed/<epoch ms>/              one row per failure

A full sync opens a folder, increments add to it. Readers of the present state list
the names of a stream's full syncs and read the newest one's folder, so superseded
commits cost a name in a listing at most. Each commit writes a folder of its own, so
streams can be synced side by side and no writer touches files another one reads.
One writer per stream is assumed.
"""

from __future__ import annotations

import time
from dataclasses import asdict, dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import condition
from tidemark.functions.frames import empty_frame
from tidemark.functions.keys import path_segment, uri
from tidemark.sources.lake import child_names

FULL, INCREMENTAL, FAILED = "full", "incremental", "failed"

LOG = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        T.StructField("sync_ms", T.LongType()),
        T.StructField("mode", T.StringType()),
        T.StructField("cursor", T.StringType()),
        T.StructField("hwm", T.StringType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("schema_json", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("full_ms", T.LongType()),
        T.StructField("key_json", T.StringType()),
    ]
)


@dataclass(frozen=True)
class Commit:
    """One row of the log."""

    stream: str
    sync_ms: int
    mode: str
    cursor: str | None = None
    hwm: str | None = None
    n_rows: int | None = None
    schema_json: str | None = None
    error: str | None = None
    full_ms: int | None = None  # the full sync it adds to, or is
    key_json: str | None = None  # names of the columns of which the last version wins


def snapshot_path(root: str, stream: str, sync_ms: int) -> str:
    return uri(root, path_segment(stream), f"sync_ms={sync_ms}")


def stream_path(root: str, stream: str) -> str:
    return uri(root, path_segment(stream))


def _log_path(root: str, stream: str | None = None) -> str:
    return uri(root, "_sync_log", path_segment(stream) if stream else "")


def log_entry(root: str, commit: Commit) -> str:
    """The folder of one log row."""
    below = "failed" if commit.mode == FAILED else str(commit.full_ms)
    return uri(_log_path(root, commit.stream), below, str(commit.sync_ms))


def append(spark: SparkSession, root: str, commit: Commit) -> None:
    """Write one log row; two commits of one stream cannot share a time."""
    values = asdict(commit)
    row = spark.range(0, 1, 1, 1).select(
        *(F.lit(values[f.name]).cast(f.dataType).alias(f.name) for f in LOG)
    )
    row.write.mode("errorifexists").parquet(log_entry(root, commit))


def read_log(spark: SparkSession, root: str, stream: str | None = None) -> DataFrame:
    """The whole log of one stream, or of all; empty where nothing was synced yet."""
    return _rows(spark, _log_path(root, stream))


def _rows(spark: SparkSession, path: str) -> DataFrame:
    reader = spark.read.schema(LOG).option("recursiveFileLookup", True)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if condition(error) != "PATH_NOT_FOUND":
            raise
        return empty_frame(spark, LOG)


def committed(spark: SparkSession, root: str, stream: str) -> DataFrame:
    """All log rows whose snapshots count or once did."""
    return read_log(spark, root, stream).filter(F.col("mode").isin(FULL, INCREMENTAL))


def live(spark: SparkSession, root: str, stream: str) -> DataFrame:
    """Log rows that make up the stream's present state: the last full one onwards."""
    folder = _log_path(root, stream)
    for name in sorted(filter(str.isdigit, child_names(spark, folder)), key=int, reverse=True):
        found = _rows(spark, uri(folder, name))
        if not found.isEmpty():  # a full sync that died while it wrote its row has none
            return found
    return empty_frame(spark, LOG)


def last_commit(spark: SparkSession, root: str, stream: str) -> Row | None:
    return live(spark, root, stream).orderBy(F.desc("sync_ms")).first()


def next_sync_ms(last: Row | None, wanted: int | None = None) -> int:
    """The wanted time or now, but always after the stream's last commit."""
    if wanted is None:
        now = int(time.time() * 1000)
        return max(now, last["sync_ms"] + 1) if last else now
    if last and wanted <= last["sync_ms"]:
        raise ValueError(f"{last['stream']!r} already has a sync at {last['sync_ms']}")
    return wanted
