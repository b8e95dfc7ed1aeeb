"""Which streams a source has, and which of them are wanted."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import LakeSource, Source
from tidemark.errors import NoData, UnknownStream
from tidemark.functions.frames import small_frame
from tidemark.sources.jdbc import dictionary_query, read_table
from tidemark.sources.lake import file_system_path, list_objects, read_lake
from tidemark.sources.listing import footers, opener

CATALOG = T.StructType(
    [
        T.StructField("schema_name", T.StringType()),
        T.StructField("stream", T.StringType()),
        T.StructField("ordinal", T.IntegerType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("dtype", T.StringType()),
    ]
)

KEEP = "schema_name, stream, path, object_name"


def _first_segments(objects: DataFrame) -> list[str]:
    """Folder or file names right below the listed root: one per stream or schema."""
    name = F.substring_index("object_name", "/", 1)
    return [r[0] for r in objects.select(name).distinct().collect()]


def _lake_catalog(
    spark: SparkSession, src: LakeSource, schemas: Sequence[str]
) -> DataFrame:
    """Files are listed and their footers read by tasks; a row per column comes back."""
    schemas = schemas or sorted(_first_segments(list_objects(spark, src.root)))
    how = opener(spark, src.root)
    parts = []
    for schema in schemas:
        try:
            found = list_objects(spark, f"{src.root.rstrip('/')}/{schema}")
        except NoData as error:
            raise UnknownStream(f"no schema {schema!r} under {src.root}") from error
        name = F.substring_index("object_name", "/", 1)
        parts.append(
            found.filter(name.endswith(src.suffix)).select(
                F.lit(schema).alias("schema_name"),
                F.substr(name, F.lit(1), F.length(name) - len(src.suffix)).alias("stream"),
                F.lit(file_system_path(src.root, schema)).alias("root"),
                "object_name",
            )
        )
    files = reduce(DataFrame.unionAll, parts)
    if how is None:
        rows, asked = [], files.select("schema_name", "stream").distinct().collect()
    else:
        rows, asked = _columns(spark, how, files)
    unsure = sorted((r["schema_name"], r["stream"]) for r in asked)
    if unsure:
        # of partitioned folders, and types a footer does not tell, Spark's reader decides
        with ThreadPoolExecutor(8) as pool:
            frames = pool.map(lambda s: read_lake(spark, src.path(*s)), unsure)
            for stream, df in zip(unsure, frames, strict=True):
                rows += [
                    (*stream, i, f.name, f.dataType.simpleString())
                    for i, f in enumerate(df.schema.fields, start=1)
                ]
    return small_frame(spark, rows, CATALOG)


def _columns(spark: SparkSession, how: dict[str, str], files: DataFrame):
    """Catalog rows, and the streams that footers alone do not decide.

    Columns come in the order of the first file, by name, that has them. Where files
    disagree on a type, or one cannot be read, the stream is among the second: reading it
    fails with the column's name.
    """
    stream = ["schema_name", "stream"]
    path = F.concat_ws("/", "root", "object_name").alias("path")
    found = footers(spark, how, files.select(*stream, path, "object_name"), KEEP)
    parted = F.col("object_name").contains("=")
    columns = found.groupBy(*stream, "column_name").agg(
        F.min(F.struct("object_name", "position")).alias("place"),
        F.min("dtype").alias("dtype"),
        F.max("dtype").alias("other"),
        F.bool_or(F.col("dtype").isNull() | F.col("problem").isNotNull() | parted).alias("odd"),
    )
    order = Window.partitionBy(*stream).orderBy("place")
    whole = Window.partitionBy(*stream)
    odd = F.bool_or(F.col("odd") | (F.col("dtype") != F.col("other"))).over(whole)
    rows = columns.select(
        *stream,
        F.row_number().over(order).alias("ordinal"),
        "column_name",
        "dtype",
        odd.alias("unsure"),
    ).collect()
    unsure = {(r["schema_name"], r["stream"]): r for r in rows if r["unsure"]}
    known = [tuple(r)[:5] for r in rows if not r["unsure"] and r["column_name"] is not None]
    return known, list(unsure.values())


def discover(
    spark: SparkSession, src: Source, schemas: Sequence[str] | None = None
) -> DataFrame:
    """One row per column of every stream in the given schemas, or in all.

    Schema names must match exactly; one without any stream fails by name. The
    restriction reaches the database's dictionary, or the folders that are listed.
    """
    schemas = list(src.schemas if schemas is None else schemas)
    if isinstance(src, LakeSource):
        catalog = _lake_catalog(spark, src, schemas)
    else:
        found = read_table(spark, src, dictionary_query(src.dictionary, schemas))
        catalog = found.select(
            *(F.col(f.name).cast(f.dataType).alias(f.name) for f in CATALOG)
        )
    _require(catalog, "schema_name", schemas, "schema")
    return catalog


def _require(catalog: DataFrame, key: str, names: Sequence[str], what: str) -> None:
    if not names:
        return
    found = catalog.filter(F.col(key).isin(names)).select(key).distinct().collect()
    missing = set(names) - {r[0] for r in found}
    if missing:
        raise UnknownStream(f"no such {what}: {', '.join(map(repr, sorted(missing)))}")


def select(catalog: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    """The catalog rows of the named streams, or all of them; names match exactly."""
    if names is None:
        return catalog
    names = list(names)
    _require(catalog, "stream", names, "stream")
    return catalog.filter(F.col("stream").isin(names))
