"""Pick up files that were not there last time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.frames import empty_frame, small_frame
from tidemark.functions.keys import decoded, uri
from tidemark.functions.schemas import widens
from tidemark.session import scratch_dir
from tidemark.sources.lake import exists, glob_escape
from tidemark.sources.listing import footers, opener

SOURCE_FILE = "source_file"
_FILES = "path string, modificationTime timestamp, length long, content binary"
_REFUSED = T.StructType(
    [T.StructField("source_file", T.StringType()), T.StructField("reason", T.StringType())]
)
_VERDICT = T.StructType(
    [
        T.StructField("column_name", T.StringType()),
        T.StructField("dtype", T.StringType()),
        T.StructField("verdict", T.StringType()),
    ]
)


def pickup_new_files(
    spark: SparkSession,
    inbox: str,
    target: str,
    checkpoint: str,
    schema: T.StructType,
    files_per_batch: int = 10_000,
    extra: str = "refuse",
) -> DataFrame:
    """Copy the rows of new Parquet files below ``inbox`` to ``target``; then stop.

    Each file is taken exactly once however often this runs: the checkpoint remembers
    the files, and a batch that is run again replaces what it wrote. Returns the rows
    picked up so far, with their ``source_file``. A backlog is worked off in batches of
    ``files_per_batch`` files, late files included; the driver keeps the names of files
    seen.

    Tasks read the footers of a batch first. A file that is broken, or whose columns have
    types that those of ``schema`` cannot hold, is set aside with the reason and the
    others go on, see ``refused_files``; so is one with further columns, unless ``extra``
    is ``"keep"``: then these are picked up too, NULL in files without them, if all files
    agree on their types. A column that a file lacks is NULL.
    """
    if extra not in ("refuse", "keep"):
        raise ValueError(f"extra must be 'refuse' or 'keep', not {extra!r}")
    if exists(spark, uri(target, "_spark_metadata")):
        raise ValueError(f"{target} was written by an earlier version; take a new target")
    found = (
        spark.readStream.schema(_FILES)
        .format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .option("maxFilesPerTrigger", files_per_batch)
        # Spark's default would pass over a file a week older than the newest one.
        .option("maxFileAge", "36500d")
        .load(inbox)
        .select("path")  # contents are not read
    )
    query = (
        found.writeStream.foreachBatch(_taker(inbox, target, schema, extra == "keep"))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    full = _target_schema(spark, target, schema) if extra == "keep" else schema
    full = T.StructType([*full.fields, T.StructField(SOURCE_FILE, T.StringType())])
    if not _has_rows(spark, target):
        return empty_frame(spark, full)
    return spark.read.schema(full).option("recursiveFileLookup", True).parquet(target)


def refused_files(spark: SparkSession, target: str) -> DataFrame:
    """The files that were set aside, and why: one row per file."""
    folder = uri(target, "_refused")
    if not exists(spark, folder):
        return empty_frame(spark, _REFUSED)
    reader = spark.read.schema(_REFUSED).option("recursiveFileLookup", True)
    return reader.parquet(folder)


def _has_rows(spark: SparkSession, target: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(uri(target, "batch-*"))
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return bool(fs.globStatus(path))


def _target_schema(spark: SparkSession, target: str, schema: T.StructType) -> T.StructType:
    """The wanted columns, and further ones that were picked up before."""
    if not _has_rows(spark, target):
        return schema
    reader = spark.read.option("recursiveFileLookup", True).option("mergeSchema", True)
    known = {*schema.names, SOURCE_FILE}
    more = [f for f in reader.parquet(target).schema.fields if f.name not in known]
    return T.StructType([*schema.fields, *more])


def _taker(
    inbox: str, target: str, schema: T.StructType, keep: bool
) -> Callable[[DataFrame, int], None]:
    def take(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        wanted = _target_schema(spark, target, schema) if keep else schema
        fit, refused, wanted = _checked(spark, inbox, batch, wanted, keep)
        refused.write.mode("overwrite").parquet(uri(target, "_refused", f"batch-{number}"))
        # names of one batch, files_per_batch at most
        paths = [glob_escape(r["path"]) for r in fit.collect()]
        if paths:
            rows = spark.read.schema(wanted).parquet(*paths)
            rows = rows.withColumn(SOURCE_FILE, decoded(F.col("_metadata.file_path")))
            rows.write.mode("overwrite").option("compression", "snappy").parquet(
                uri(target, f"batch-{number}")
            )

    return take


def _checked(
    spark: SparkSession, inbox: str, batch: DataFrame, wanted: T.StructType, keep: bool
) -> tuple[DataFrame, DataFrame, T.StructType]:
    """The files that fit, those that do not, and the schema to read the former by."""
    files = batch.select("path").distinct()
    how = opener(spark, inbox)
    if how is None:  # tasks cannot look: Spark's reader decides, and fails the run
        return files, empty_frame(spark, _REFUSED), wanted
    bare = "^[a-zA-Z0-9]+://" if how["scheme"] == "s3" else "^file:(//[^/]*)?"
    opened = files.select(
        F.col("path").alias("name"), F.regexp_replace("path", bare, "").alias("path")
    )
    read = footers(spark, how, opened, "path, name")
    folder = scratch_dir(spark, "footers")
    read.write.parquet(folder)
    read = spark.read.schema(read.schema).parquet(folder)
    kinds = read.filter("column_name IS NOT NULL").groupBy("column_name", "dtype").count()
    rows = sorted(map(tuple, kinds.collect()), key=lambda r: (r[0], -r[2], str(r[1])))
    have, verdicts, more = {f.name: f.dataType for f in wanted.fields}, [], []
    for name, dtype, _ in rows:  # a kind of column each, the usual one first
        kind = T.DataType.fromDDL(dtype) if dtype else None
        if name == SOURCE_FILE:
            verdicts.append((name, dtype, f"{name}: a column of the result"))
        elif name not in have and not keep:
            verdicts.append((name, dtype, f"{name}: not wanted"))
        elif name not in have and kind is None:
            verdicts.append((name, dtype, f"{name}: of a type that footers do not tell"))
        elif name not in have:
            have[name] = kind
            more.append(T.StructField(name, kind))
        elif kind is not None and not widens(kind, have[name]):
            against = have[name].simpleString()
            verdicts.append((name, dtype, f"{name}: {dtype} against {against}"))
    why = small_frame(spark, verdicts, _VERDICT)
    same = (read["column_name"] == why["column_name"]) & read["dtype"].eqNullSafe(why["dtype"])
    judged = read.join(F.broadcast(why), same, "left").groupBy("name")
    reason = F.array_join(
        F.array_sort(F.collect_set(F.coalesce("problem", "verdict"))), "; "
    )
    judged = judged.agg(reason.alias("reason"))
    fit = judged.filter("reason = ''").select(F.col("name").alias("path"))
    refused = judged.filter("reason <> ''").select(F.col("name").alias("source_file"), "reason")
    return fit, refused, T.StructType([*wanted.fields, *more])
