"""Object listings and Parquet reads under a lake root."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import NoData, SchemaDrift, condition, first_line
from tidemark.functions.frames import empty_frame, small_frame
from tidemark.functions.keys import decoded, has_extension, uri
from tidemark.functions.schemas import differences
from tidemark.sources.listing import listed, opener

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:(//[^/]*)?"


def glob_escape(text: str) -> str:
    return re.sub(r"([\\*?\[\]{},])", r"\\\1", text)


def _root_path(root: str) -> str:
    path = re.sub(r"/+", "/", re.sub(_SCHEME, "", root)).rstrip("/")
    if path and not path.startswith("/"):
        raise ValueError(f"the root must be absolute or carry a scheme: {root!r}")
    return path


def child_names(spark: SparkSession, folder: str) -> list[str]:
    """Names right below a folder, files and folders alike; none if it is missing."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not fs.exists(path):
        return []
    return [status.getPath().getName() for status in fs.listStatus(path)]


OBJECTS = T.StructType(
    [
        T.StructField("object_name", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("modified_at", T.TimestampType()),
    ]
)


def object_name(root: str) -> Column:
    """The name, relative to ``root``, of the file a row came from."""
    path = F.regexp_replace(decoded(F.col("_metadata.file_path")), _SCHEME, "")
    return F.substr(path, F.lit(len(_root_path(root)) + 2))


def file_system_path(root: str, *parts: str) -> str:
    """A path as tasks open it: on object stores the bucket is its first part."""
    path = _root_path(root)
    if root.partition(":")[0] in ("s3", "s3a"):
        path = re.sub(r"^[^:]*://", "", root).strip("/")
    return "/".join([path, *parts])


def exists(spark: SparkSession, path: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(path)


def _mask(glob: str) -> str:
    """A glob of file names as a regular expression."""
    out, depth, k = "", 0, 0
    while k < len(glob):
        c = glob[k]
        if c == "\\" and k + 1 < len(glob):
            k += 1
            out += re.escape(glob[k])
        elif c == "[":
            end = glob.find("]", k + 2)
            if end < 0:
                raise ValueError(f"an open bracket in {glob!r}")
            inside = glob[k + 1 : end].replace("\\", "\\\\")
            out += "[" + ("^" + inside[1:] if inside[0] in "^!" else inside) + "]"
            k = end
        elif c == "{":
            depth, out = depth + 1, out + "(?:"
        elif c == "}" and depth:
            depth, out = depth - 1, out + ")"
        elif c == "," and depth:
            out += "|"
        else:
            out += {"*": ".*", "?": "."}.get(c) or re.escape(c)
        k += 1
    return f"^(?:{out})$"


def list_objects(
    spark: SparkSession,
    root: str,
    prefix: str = "",
    glob: str | None = None,
    extensions: Iterable[str] | None = None,
) -> DataFrame:
    """Every object under ``root`` whose name starts with ``prefix``, empty ones too.

    Names are relative to the root. The prefix picks what is listed: its folder, and in
    it only names that go on from it. ``glob`` fits file names. Tasks list the folders,
    a level at a time, when this is called; no content is read and no list of names comes
    to the driver. A prefix that matches nothing gives no rows; a missing root fails.
    Objects named with a leading ``_`` or ``.`` are markers and not listed.

    On file systems that tasks cannot open by themselves Spark's own listing is asked,
    whose names the driver holds.
    """
    extensions = tuple(extensions) if extensions is not None else None
    start = file_system_path(root)
    if not exists(spark, root):
        raise NoData(f"nothing at {root}")
    how = opener(spark, root)
    if how is None:
        objects = _indexed(spark, root, prefix, glob)
    else:
        folder, _, first = prefix.rpartition("/")
        folder = f"{start}/{folder}".rstrip("/")
        found = listed(spark, how, folder or "/", first)
        name = F.substr("path", F.lit(len(start) + 2))
        objects = found.select(name.alias("object_name"), "length", "modified_at")
        if glob:
            last = F.substring_index("object_name", "/", -1)
            objects = objects.filter(last.rlike(_mask(glob)))
    if prefix:
        objects = objects.filter(F.col("object_name").startswith(prefix))
    if extensions is not None:
        objects = objects.filter(has_extension("object_name", extensions))
    return objects


def _indexed(spark: SparkSession, root: str, prefix: str, glob: str | None) -> DataFrame:
    """The objects as a scan of them would find them; empty ones have no time."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    start = uri(root, glob_escape(prefix)) if prefix else root
    if prefix.endswith("/"):
        start += "/"
    if prefix:
        start += "*"
    try:
        found = reader.load(start)
    except AnalysisException as error:
        if condition(error) != "PATH_NOT_FOUND":
            raise
        return empty_frame(spark, OBJECTS)
    # A scan has no task for an empty object; the listing behind it has its name.
    drop = len(_root_path(root)) + 1
    names = [(unquote(re.sub(_SCHEME, "", f))[drop:],) for f in found.inputFiles()]
    known = small_frame(spark, names, T.StructType([OBJECTS["object_name"]]))
    scanned = found.select(
        object_name(root).alias("object_name"),
        F.col("_metadata.file_size").alias("length"),
        F.col("_metadata.file_modification_time").alias("modified_at"),
    )
    return known.join(scanned, "object_name", "left").select(
        "object_name", F.coalesce("length", F.lit(0).cast("bigint")).alias("length"), "modified_at"
    )


def read_lake(
    spark: SparkSession, root: str, key: str = "", one_schema: bool = False
) -> DataFrame:
    """Parquet at ``root/key``: a file, a folder or a glob.

    The job that finds the schema reads the footers of all files, side by side:
    columns that only some files have are kept, NULL elsewhere, and a column whose
    type differs between files fails by name. ``one_schema=True`` looks at one footer
    alone and suits large folders that one job wrote; columns which that file lacks
    are then not read.
    """
    return read_files(spark, [uri(root, key) if key else root], one_schema)


def read_files(
    spark: SparkSession, paths: Sequence[str], one_schema: bool = False
) -> DataFrame:
    """Parquet at several paths, see ``read_lake``."""
    reader = spark.read.option("mergeSchema", not one_schema)
    where = paths[0] if len(paths) == 1 else f"{len(paths)} paths such as {paths[0]}"
    try:
        return reader.parquet(*paths)
    except AnalysisException as error:
        if condition(error) in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise NoData(f"no Parquet data at {where}") from error
        raise
    except Exception as error:
        if "CANNOT_MERGE" in str(error):
            raise SchemaDrift(f"files at {where} disagree: {_conflict(error)}") from error
        raise


def _conflict(error: Exception) -> str:
    """The columns of a failed schema merge, from the two schemas Spark reports."""
    found = re.findall(r'^"(STRUCT<.*>)"', str(error), re.MULTILINE)
    try:
        left, right = (T.DataType.fromDDL(text) for text in found)
    except Exception:  # not two schemas that can be read back
        return first_line(error)
    both = set(left.names) & set(right.names)
    left, right = (
        T.StructType([f for f in s.fields if f.name in both]) for s in (left, right)
    )
    return "; ".join(differences(left, right)) or first_line(error)
