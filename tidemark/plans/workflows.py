"""The four workflows a user runs end to end."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from tidemark.config import Source
from tidemark.functions.keys import path_segment, uri
from tidemark.operators import snapshots
from tidemark.operators.profile import (
    column_list,
    preview_head,
    profile_info,
    stream_shape,
)
from tidemark.operators.raw import land_raw
from tidemark.operators.sinks import write_csv
from tidemark.operators.sync import StreamPlan, configured_catalog, sync
from tidemark.operators.synclog import FULL, INCREMENTAL
from tidemark.sources.catalog import discover, select


def _plans(
    spark: SparkSession,
    src: Source,
    streams: Sequence[str] | None,
    cursors: Mapping[str, str],
    full_refresh: bool,
    split_by: Mapping[str, str],
    tasks: int,
) -> list[StreamPlan]:
    chosen = select(discover(spark, src), streams)
    pairs = chosen.select("schema_name", "stream").distinct().collect()
    unknown = (set(cursors) | set(split_by)) - {p["stream"] for p in pairs}
    if unknown:
        raise ValueError(f"columns for streams that are not selected: {sorted(unknown)}")
    holders = Counter(p["stream"] for p in pairs)
    plans = [
        StreamPlan(
            stream,
            FULL if full_refresh or stream not in cursors else INCREMENTAL,
            cursors.get(stream),
            schema,
            target=f"{schema}.{stream}" if holders[stream] > 1 else None,
            split_by=split_by.get(stream),
            tasks=tasks,
        )
        for schema, stream in sorted((p["schema_name"], p["stream"]) for p in pairs)
    ]
    configured_catalog(chosen, plans)
    return plans


def migrate(
    spark: SparkSession,
    src: Source,
    root: str,
    streams: Sequence[str] | None = None,
    cursors: Mapping[str, str] | None = None,
    full_refresh: bool = False,
    parallel: int = 4,
    split_by: Mapping[str, str] | None = None,
    tasks: int = 64,
) -> DataFrame:
    """Discover, select and land streams; returns the log rows.

    Streams with a cursor are synced incrementally unless ``full_refresh``. A name
    that several schemas hold is landed as ``<schema>.<stream>``. ``split_by`` names
    the columns that share out database reads over ``tasks``, see ``StreamPlan``.
    """
    plans = _plans(
        spark, src, streams, cursors or {}, full_refresh, split_by or {}, tasks
    )
    return sync(spark, src, root, plans, parallel=parallel)


def extract(
    spark: SparkSession,
    src: Source,
    root: str,
    csv_root: str,
    streams: Sequence[str],
    cursors: Mapping[str, str] | None = None,
    parallel: int = 4,
    split_by: Mapping[str, str] | None = None,
    tasks: int = 64,
) -> dict[str, DataFrame]:
    """Land streams in full, write each as CSV too, and return them by landed name.

    The source is read once; the CSV and the results come from the landed copy.
    """
    log = migrate(spark, src, root, streams, cursors, True, parallel, split_by, tasks)
    landed = [r["stream"] for r in log.select("stream").collect()]
    tables = {name: snapshots.current(spark, root, name) for name in landed}
    copy = inheritable_thread_target(spark)(write_csv)
    with ThreadPoolExecutor(max(1, parallel)) as pool:
        jobs = [
            pool.submit(copy, df, uri(csv_root, path_segment(name)))
            for name, df in tables.items()
        ]
    for job in jobs:
        job.result()
    return tables


def read_back(
    spark: SparkSession, folder: str, order_by: str, key: str = "", rows: int = 5
) -> dict[str, DataFrame]:
    """A landed sync file, or the newest, with its preview and profile."""
    df = snapshots.read_back(spark, folder, key)
    return {
        "data": df,
        "head": preview_head(df, order_by, rows),
        "info": profile_info(df),
        "shape": stream_shape(df, key or folder.rstrip("/").rpartition("/")[2]),
        "columns": column_list(df),
    }


def land_folders(
    spark: SparkSession, raw_root: str, out_root: str, prefix: str = "raw"
) -> DataFrame:
    """Land every folder of raw Parquet files below ``prefix``."""
    return land_raw(spark, raw_root, out_root, prefix=prefix)
