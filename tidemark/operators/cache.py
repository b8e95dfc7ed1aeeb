"""Streams kept for reuse under their names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.errors import NoData, UnknownStream
from tidemark.operators import synclog
from tidemark.operators.sinks import land
from tidemark.operators.snapshots import current
from tidemark.session import scratch_dir


class StreamCache:
    """Named streams as snapshots below a shared folder, each also a temp view.

    Written rather than persisted: cached blocks die with their executor and
    would be read from the source anew, which may have changed by then. A cache
    opened on the root of an earlier one, or of a sync, has its streams.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root or scratch_dir(spark, "cache")

    def put(self, name: str, df: DataFrame) -> DataFrame:
        """Keep a stream in place of an earlier one; readers of that keep their files."""
        land(df, self.root, name)
        return self.view(name)

    def view(self, name: str) -> DataFrame:
        """The stream, also registered as a temp view of its name."""
        kept = self[name]
        kept.createOrReplaceTempView("`" + name.replace("`", "``") + "`")
        return kept

    def __getitem__(self, name: str) -> DataFrame:
        try:
            return current(self.spark, self.root, name)
        except NoData as error:
            raise UnknownStream(f"{name!r} is not cached; have {list(self)}") from error

    def __contains__(self, name: str) -> bool:
        return synclog.last_commit(self.spark, self.root, name) is not None

    def __iter__(self):
        log = synclog.read_log(self.spark, self.root).filter(
            F.col("mode") != synclog.FAILED
        )
        return iter(sorted(r[0] for r in log.select("stream").distinct().collect()))
