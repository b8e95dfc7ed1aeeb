"""Which raw objects a stream's commits have taken: a row per object and commit.

``<root>/_sync_files/<stream>/<full ms>/<epoch ms>/`` is written before the commit's log
row and counts only with it, so an object is never taken for landed when it is not.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import condition
from tidemark.functions.keys import path_segment, uri
from tidemark.operators import synclog

LEDGER = T.StructType(
    [
        T.StructField("object_name", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("modified_at", T.TimestampType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("sync_ms", T.LongType()),
    ]
)


def _folder(root: str, stream: str, full_ms: int) -> str:
    return uri(root, "_sync_files", path_segment(stream), str(full_ms))


def record(objects: DataFrame, root: str, stream: str, full_ms: int, sync_ms: int) -> None:
    """Note objects (the columns of LEDGER but the last) as taken by a commit."""
    rows = objects.withColumn("sync_ms", F.lit(sync_ms)).select(
        *(F.col(f.name).cast(f.dataType) for f in LEDGER)
    )
    rows.write.mode("append").parquet(uri(_folder(root, stream, full_ms), str(sync_ms)))


def taken(spark: SparkSession, root: str, stream: str) -> DataFrame | None:
    """The objects that the stream's present commits took; None where none were noted."""
    live = synclog.live(spark, root, stream)
    last = live.first()
    if last is None:
        return None
    reader = spark.read.schema(LEDGER).option("recursiveFileLookup", True)
    try:
        rows = reader.parquet(_folder(root, stream, last["full_ms"]))
    except AnalysisException as error:
        if condition(error) != "PATH_NOT_FOUND":
            raise
        return None
    return rows.join(live.select("sync_ms").distinct(), "sync_ms", "left_semi").select(
        *LEDGER.names
    )
