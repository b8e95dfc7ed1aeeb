"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping
from functools import cache

from pyspark.sql import SparkSession

from tidemark.functions.keys import uri

DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    # Many small sync jobs may run at once beside a huge one.
    "spark.scheduler.mode": "FAIR",
}


# A shuffle has a block per pair of tasks, so both sides are kept to a number that a
# driver and the shuffle service can track; past it tasks grow instead, and spill.
TASK_BYTES, MOST_READERS, MOST_WRITERS = 256 << 20, 50_000, 100_000
SCAN_BYTES, MOST_SCAN_BYTES = 128 << 20, 1 << 30


def sized_for(
    largest_shuffle: int,
    most_readers: int = MOST_READERS,
    most_writers: int = MOST_WRITERS,
    most_scan_bytes: int = MOST_SCAN_BYTES,
) -> dict[str, str]:
    """Scan and shuffle task sizes for so many bytes.

    By default tasks grow past 256 MiB beyond 12 TiB, to 2 GiB at 100 TB; a cluster
    whose shuffle service copes with more blocks may allow for more tasks.
    """
    readers = min(most_readers, max(200, -(-largest_shuffle // TASK_BYTES)))
    scan = min(most_scan_bytes, max(SCAN_BYTES, largest_shuffle // most_writers))
    return {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(readers),
        "spark.sql.files.maxPartitionBytes": str(scan),
    }


def build_session(
    app: str = "tidemark",
    master: str | None = None,
    conf: Mapping[str, str] | None = None,
    largest_shuffle: int | None = None,
) -> SparkSession:
    """A session with this library's defaults; ``conf`` wins over them.

    ``largest_shuffle`` is the number of bytes the largest shuffle moves, about the
    uncompressed size of the streams to reconcile; scans and shuffles are then cut
    for it. Partitions of smaller shuffles are merged at run time.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULTS)
    if largest_shuffle:
        settings |= sized_for(largest_shuffle)
    for key, value in (settings | dict(conf or {})).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_tasks(spark: SparkSession) -> int:
    """How many tasks a shuffle of this session starts with."""
    plain = spark.conf.get("spark.sql.shuffle.partitions")
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    return max(int(plain), int(spark.conf.get(name, None) or 0))


@cache
def _local_dir() -> str:
    return "file:" + tempfile.mkdtemp(prefix="tidemark-")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Without the setting only a local master may go on, in a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_dir()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, grouped by application."""
    app = spark.conf.get("spark.app.id", "session")
    return uri(
        shared_dir(spark), f"tidemark-{app}", f"{label}-{uuid.uuid4().hex[:12]}"
    )
