"""Syncing streams from a source into the lake."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import astuple, dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import is_remote

from tidemark.config import JdbcSource, Source
from tidemark.errors import (
    CursorRefused,
    SchemaDrift,
    SyncFailed,
    UnknownStream,
    first_line,
)
from tidemark.functions.cursors import column, cursor_type, from_text, upto
from tidemark.functions.frames import small_frame
from tidemark.functions.schemas import as_schema, narrowings
from tidemark.operators import ledger, synclog
from tidemark.operators.sinks import land
from tidemark.operators.snapshots import current
from tidemark.operators.synclog import FAILED, FULL, INCREMENTAL, LOG, Commit
from tidemark.sources.catalog import select
from tidemark.sources.jdbc import (
    Split,
    Stride,
    balanced_cuts,
    key_split,
    moment_of,
    range_split,
    stride_for,
)
from tidemark.sources.streams import newer_rows, owner, read_stream, source_mark

_CONFIGURED = T.StructType(
    [
        T.StructField(n, T.StringType())
        for n in ("stream", "target", "mode", "cursor", "in_schema")
    ]
)


@dataclass(frozen=True)
class StreamPlan:
    """How one stream is synced.

    ``incremental`` falls back to a full sync while the stream has none.
    ``inclusive`` also picks up late rows at the last seen cursor value.
    ``key``, columns that name a row, makes an increment's row take the place of earlier
    ones: an update that moves the cursor is then there once. Deletes are not seen.
    ``target`` is the stream's name in the lake, if it should differ. A database
    read is one task unless ``partition`` or ``split_by``, an integer or decimal
    column with nearly unique values cut for ``tasks`` readers, shares it out. Every
    reader of an increment filters the same rows by the cursor: give the cursor an
    index in the database, or each of them scans the table. ``one_moment`` has all readers
    of an Oracle table, and the maximum of its cursor, see it as of one system change
    number; the database must keep its undo that long.
    """

    stream: str
    mode: str = FULL
    cursor: str | None = None
    schema: str | None = None
    partition: Stride | Split | None = None
    inclusive: bool = False
    target: str | None = None
    max_records_per_file: int = 0
    split_by: str | None = None
    tasks: int = 64
    key: Sequence[str] | None = None
    one_moment: bool = False

    def __post_init__(self):
        if self.mode not in (FULL, INCREMENTAL):
            raise ValueError(f"mode must be {FULL!r} or {INCREMENTAL!r}")
        if self.mode == INCREMENTAL and not self.cursor:
            raise ValueError(f"an incremental sync of {self.stream!r} needs a cursor")
        if isinstance(self.key, str) or (self.key is not None and not self.key):
            raise ValueError(f"key must be a list of column names, not {self.key!r}")
        if self.tasks < 1:
            raise ValueError(f"tasks must be positive, not {self.tasks}")

    @property
    def name(self) -> str:
        return self.target or self.stream


def configured_catalog(catalog: DataFrame, plans: Iterable[StreamPlan | str]) -> DataFrame:
    """What a sync would do: one row per selected stream, with mode and cursor.

    Unknown streams and cursors fail by name, before any row is read.
    """
    plans = _as_plans(plans)
    chosen = select(catalog, [p.stream for p in plans])
    listed = small_frame(
        catalog.sparkSession,
        [(p.stream, p.name, p.mode, p.cursor, p.schema) for p in plans],
        _CONFIGURED,
    )
    found = (
        chosen.join(listed, "stream")
        .filter(F.col("schema_name") == F.coalesce("in_schema", "schema_name"))
        .groupBy("schema_name", "stream", "target", "mode", "cursor")
        .agg(
            F.count(F.lit(1)).alias("n_columns"),
            F.count_if(F.col("column_name") == F.col("cursor")).alias("n_cursors"),
        )
    )
    rows = found.collect()  # one per plan
    absent = {p.name for p in plans} - {r["target"] for r in rows}
    if absent:
        raise UnknownStream(f"not in the plan's schema: {sorted(absent)}")
    refused = [
        f"{r['stream']!r} has no column {r['cursor']!r}"
        for r in rows
        if r["cursor"] is not None and not r["n_cursors"]
    ]
    if refused:
        raise CursorRefused("; ".join(sorted(refused)))
    return found.drop("n_cursors")


def _as_plans(plans: Iterable[StreamPlan | str]) -> list[StreamPlan]:
    return [StreamPlan(p) if isinstance(p, str) else p for p in plans]


def sync_stream(
    spark: SparkSession,
    src: Source,
    root: str,
    plan: StreamPlan,
    sync_ms: int | None = None,
) -> Commit:
    """Sync one stream and commit it.

    With a cursor the source's maximum is fixed first and bounds the rows that are
    read, in a full sync too. Parallel reads see the source at different moments;
    without that bound the logged mark could pass rows that were not read, or the
    next sync could read some twice.
    """
    last = synclog.last_commit(spark, root, plan.name)
    adds = plan.mode == INCREMENTAL and last is not None
    if adds and last["cursor"] != plan.cursor:
        raise CursorRefused(
            f"{plan.name!r} was synced by {last['cursor']!r}, not {plan.cursor!r};"
            " do a full sync"
        )
    had = json.loads(last["key_json"] or "null") if adds else None
    if had is not None and plan.key is not None and list(plan.key) != had:
        raise ValueError(f"{plan.name!r} was synced by key {had}; do a full sync")
    partition = _partition(spark, src, root, plan, last, adds)
    moment = None
    if plan.one_moment and isinstance(src, JdbcSource):
        moment = moment_of(spark, src)
    df = read_stream(spark, src, plan.stream, partition, plan.schema, moment)
    mark = since = last["hwm"] if adds else None
    if plan.cursor:
        dtype, at = cursor_type(df, plan.cursor), column(plan.cursor)
        mark = source_mark(
            spark, src, plan.stream, plan.cursor, plan.schema, since, df, moment
        )
    if not adds:
        if plan.cursor:
            unset = at.isNull()
            df = df.filter(
                unset if mark is None else upto(at, from_text(mark, dtype), dtype) | unset
            )
    else:
        inclusive = plan.inclusive and since is not None
        if mark is None:
            if not inclusive:
                return idle(plan.name, last)
            mark = since
        landed = None
        if inclusive:  # the rows of a narrower schema, as this one has them
            landed = current(spark, root, plan.name)
            unlike = narrowings(landed.schema, df.schema)
            if unlike:
                changed = "; ".join(unlike)
                raise SchemaDrift(f"{plan.name!r} changed: {changed}; do a full sync")
            landed = as_schema(landed, df.schema)
        df = newer_rows(
            df,
            plan.cursor,
            None if since is None else from_text(since, dtype),
            from_text(mark, dtype),
            inclusive,
            landed,
        )
    return land(
        df,
        root,
        plan.name,
        sync_ms,
        INCREMENTAL if adds else FULL,
        plan.cursor,
        mark,
        plan.max_records_per_file,
        last,
        plan.key,
    )


def compact(
    spark: SparkSession, root: str, stream: str, files: int | None = None
) -> Commit:
    """Land a stream's present rows anew as one full sync, without the source.

    Many small increments make many small files; ``files`` is how many tasks, and
    so files, to merge them into. The mark stays where it is.
    """
    last = synclog.last_commit(spark, root, stream)
    rows = current(spark, root, stream)
    if files:
        rows = rows.coalesce(files)
    key = json.loads(last["key_json"] or "null")
    objects = ledger.taken(spark, root, stream)

    def keep(commit: Commit) -> None:
        if objects is not None:
            ledger.record(objects, root, stream, commit.full_ms, commit.sync_ms)

    return land(
        rows,
        root,
        stream,
        cursor=last["cursor"],
        hwm=last["hwm"],
        last=last,
        key=key,
        before_commit=keep,
    )


def idle(stream: str, last) -> Commit:
    """What the log says already: a sync that finds nothing leaves no trace in it."""
    return Commit(
        stream,
        last["sync_ms"],
        INCREMENTAL,
        last["cursor"],
        last["hwm"],
        0,
        last["schema_json"],
        full_ms=last["full_ms"],
        key_json=last["key_json"],
    )


def _partition(
    spark: SparkSession, src: Source, root: str, plan: StreamPlan, last, adds: bool
) -> Stride | Split | None:
    """How a database read is cut: as given, or by ``split_by``.

    A full read takes ranges of about equal row counts, found in the landed copy;
    a first one takes equal-width ranges. An increment lies anywhere in the key's
    range, so it is cut by remainder: each task looks only at rows above the mark.
    """
    if plan.partition or not plan.split_by or not isinstance(src, JdbcSource):
        return plan.partition
    if adds:
        return key_split(plan.split_by, plan.tasks)
    if last is None or not last["n_rows"]:
        owned_by = owner(src, plan.schema)
        return stride_for(spark, src, owned_by, plan.stream, plan.split_by, plan.tasks)
    landed = current(spark, root, plan.name)
    return range_split(plan.split_by, balanced_cuts(landed, plan.split_by, plan.tasks))


def each_stream(
    spark: SparkSession,
    root: str,
    work: dict[str, Callable[[], Commit]],
    parallel: int,
    redact: Callable[[str], str] = str,
) -> DataFrame:
    """Run one job per stream, several at a time; return the log rows.

    A failing stream gets a ``failed`` row and the others go on; the call then
    ends in ``SyncFailed``.
    """
    commits, failures = [], {}

    def in_own_pool(name: str, job: Callable[[], Commit]) -> Commit:
        # Streams share the cluster fairly where the scheduler mode is FAIR.
        if not is_remote():
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"sync {name}")
        return job()

    with ThreadPoolExecutor(max(1, parallel)) as pool:
        running = {
            name: pool.submit(inheritable_thread_target(spark)(in_own_pool), name, job)
            for name, job in work.items()
        }
        for name, job in running.items():
            try:
                commits.append(astuple(job.result()))
            except Exception as error:
                why = redact(first_line(error))
                failures[name] = why
                ms = synclog.next_sync_ms(None)
                try:
                    synclog.append(spark, root, Commit(name, ms, FAILED, error=why))
                except Exception as unlogged:  # the streams' own failures come first
                    failures[name] += f" (not logged: {redact(first_line(unlogged))})"
    if failures:
        raise SyncFailed(failures)
    return small_frame(spark, commits, LOG)


def sync(
    spark: SparkSession,
    src: Source,
    root: str,
    plans: Iterable[StreamPlan | str],
    sync_ms: int | None = None,
    parallel: int = 4,
) -> DataFrame:
    """Sync several streams; returns their rows of the log.

    A plain name stands for a full sync. Every stream is its own Spark job;
    ``parallel`` of them run at once so that small tables fill the gaps a large
    one leaves.
    """
    plans = _as_plans(plans)
    names = [p.name for p in plans]
    if len(set(names)) != len(names) or not names:
        raise ValueError(f"streams must be given, each once: {names}")
    work = {
        p.name: (lambda p=p: sync_stream(spark, src, root, p, sync_ms)) for p in plans
    }
    return each_stream(spark, root, work, parallel, src.redact)

