"""Landing folders of raw Parquet files, one dataset per folder."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.errors import NoData, SchemaDrift, first_line
from tidemark.functions.keys import uri
from tidemark.operators import ledger, synclog
from tidemark.operators.sinks import land
from tidemark.operators.snapshots import current
from tidemark.operators.sync import each_stream, idle
from tidemark.operators.synclog import FULL, INCREMENTAL, Commit
from tidemark.session import scratch_dir
from tidemark.sources.lake import glob_escape, list_objects, object_name, read_files

SOURCE_FILE = "source_file"


def raw_datasets(spark: SparkSession, raw_root: str, ext: str = ".parquet") -> list[str]:
    """Names of the folders right below the root that hold matching files."""
    parts = F.split("object_name", "/")
    found = (
        list_objects(spark, raw_root, extensions=(ext,))
        .filter(F.size(parts) == 2)
        .select(parts[0])
        .distinct()
    )
    return sorted(r[0] for r in found.collect())


def land_raw(
    spark: SparkSession,
    raw_root: str,
    out_root: str,
    ext: str = ".parquet",
    prefix: str = "",
    mode: str = FULL,
    parallel: int = 4,
) -> DataFrame:
    """Land every ``<raw_root>/<dataset>/*<ext>`` as a stream; returns the log rows.

    Each row keeps the name of its raw object, ``<dataset>/<file>``, as SOURCE_FILE.
    ``incremental`` adds the files that no run has taken yet, empty ones included, so a
    repeated run adds nothing; a dataset seen for the first time is landed in full, and so
    is one of which a file was replaced, as its length or time shows. Datasets may
    differ in schema, the files of one may not disagree on a column's type. A column
    only some files have is kept, NULL elsewhere. Rows of files with equal names in
    different folders stay apart.
    """
    names = raw_datasets(spark, raw_root, ext)
    if not names:
        raise NoData(f"no folder with *{ext} files under {raw_root}")
    target = uri(out_root, prefix)

    def job(name: str) -> Commit:
        last = synclog.last_commit(spark, target, name)
        adds = mode == INCREMENTAL and last is not None
        listed = _listed(spark, raw_root, name, ext)
        paths = [uri(raw_root, glob_escape(name), "*" + glob_escape(ext))]
        if adds:
            new, replaced = _news(listed, _taken(spark, target, name))
            if replaced:
                warnings.warn(
                    f"dataset {name!r}: landed in full, as files were replaced, such as"
                    f" {replaced!r}",
                    stacklevel=2,
                )
                adds = False
            else:
                listed = new
                # the driver holds their names, as the scan of them would
                names = [r[0] for r in new.select("object_name").collect()]
                paths = sorted(uri(raw_root, glob_escape(n)) for n in names)
                if not paths:
                    return idle(name, last)
        try:
            rows = read_files(spark, paths)
        except SchemaDrift as error:
            raise SchemaDrift(f"dataset {name!r}: {first_line(error)}") from error
        if SOURCE_FILE in rows.columns:
            raise SchemaDrift(f"dataset {name!r} has a column {SOURCE_FILE!r} of its own")
        df = rows.withColumn(SOURCE_FILE, object_name(raw_root))

        def note(commit: Commit) -> None:
            objects = _objects(rows, raw_root, listed)
            ledger.record(objects, target, name, commit.full_ms, commit.sync_ms)

        if adds and df.isEmpty():  # nothing to land, but no need to look again
            done = idle(name, last)
            note(done)
            return done
        kind = INCREMENTAL if adds else FULL
        return land(df, target, name, mode=kind, last=last, before_commit=note)

    return each_stream(
        spark, target, {n: (lambda n=n: job(n)) for n in names}, parallel
    )


def _listed(spark: SparkSession, raw_root: str, name: str, ext: str) -> DataFrame:
    """Name, length and time of a dataset's files, as they are now: kept in the shared
    folder, since they are asked for more than once."""
    here = F.size(F.split("object_name", "/")) == 2
    found = list_objects(spark, raw_root, f"{name}/", extensions=(ext,)).filter(here)
    path = scratch_dir(spark, "listed")
    found.write.parquet(path)
    return spark.read.schema(found.schema).parquet(path)


def _taken(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The files that have landed. Streams landed before files were noted tell their
    names alone, from all their rows."""
    noted = ledger.taken(spark, root, name)
    if noted is not None:
        return noted
    rows = current(spark, root, name).select(F.col(SOURCE_FILE).alias("object_name")).distinct()
    unknown = [F.lit(None).cast(f.dataType).alias(f.name) for f in ledger.LEDGER.fields[1:]]
    return rows.select("object_name", *unknown)


def _news(listed: DataFrame, taken: DataFrame) -> tuple[DataFrame, str | None]:
    """The files that are not among those taken, and the name of one that is, but with
    another length or time."""
    seen = taken.groupBy("object_name").agg(
        F.max_by(F.struct("length", "modified_at"), "sync_ms").alias("seen"),
        F.lit(True).alias("known"),
    )
    both = listed.join(seen, "object_name", "left")
    changed = (F.col("seen.length") != F.col("length")) | (
        F.col("seen.modified_at") != F.col("modified_at")
    )
    replaced = both.filter(F.col("known") & F.coalesce(changed, F.lit(False))).first()
    new = both.filter(F.col("known").isNull()).select(*listed.columns)
    return new, replaced and replaced["object_name"]


def _objects(rows: DataFrame, raw_root: str, listed: DataFrame) -> DataFrame:
    """The files that ``rows`` come from, with their rows, and the listed ones without any. A
    file that came after the listing is among the first, so it is not read again."""
    read = rows.select(
        object_name(raw_root).alias("object_name"),
        F.col("_metadata.file_size").alias("length"),
        F.col("_metadata.file_modification_time").alias("modified_at"),
    )
    none = F.lit(0).cast("bigint")
    both = read.withColumn("n", F.lit(1).cast("bigint")).unionByName(
        listed.withColumn("n", none)
    )
    # what was read decides on length and time
    return both.groupBy("object_name").agg(
        F.max_by("length", "n").alias("length"),
        F.max_by("modified_at", "n").alias("modified_at"),
        F.sum("n").alias("n_rows"),
    )
