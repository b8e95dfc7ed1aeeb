"""Folders listed, and Parquet footers read, by tasks.

Folders are listed level by level: those of one level are dealt to tasks, and what they
hold is written to the shared folder, the next level's folders among it. No list of names
is held by the driver. Tasks open the file system through ``pyarrow.fs``: local mounts,
and ``s3a`` with the session's own settings. For others ``opener`` gives None.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.frames import small_frame
from tidemark.session import scratch_dir, shuffle_tasks

_FOUND = "path string, is_folder boolean, length long, modified_ms long"
# Folders of one task.
FOLDERS_PER_TASK, FILES_PER_TASK = 20, 50
# Rows handed over at once.
_ROWS = 10_000


def opener(spark: SparkSession, root: str) -> dict[str, str] | None:
    """What a task needs to open the file system of ``root``; None if it cannot."""
    scheme, rest, _ = root.partition(":") if ":" in root.split("/", 1)[0] else ("", "", "")
    hadoop = spark._jsparkSession.sessionState().newHadoopConf()
    if not scheme:
        scheme = (hadoop.get("fs.defaultFS") or "file").split(":", 1)[0]
    if scheme == "file":
        return {"scheme": "file"}
    if scheme not in ("s3a", "s3"):
        return None
    names = ("access.key", "secret.key", "session.token", "endpoint", "endpoint.region")
    names += ("connection.ssl.enabled",)
    found = {n: hadoop.get(f"fs.s3a.{n}") for n in names}
    return {"scheme": "s3"} | {n: v for n, v in found.items() if v}


def _opened(how: dict[str, str]):
    """A file system of ``pyarrow``. Self-contained, as are the functions that tasks run:
    executors need not have this package."""
    import pyarrow.fs as pafs

    if how["scheme"] == "file":
        return pafs.LocalFileSystem()
    endpoint = how.get("endpoint", "")
    plain = how.get("connection.ssl.enabled") == "false" or endpoint.startswith("http://")
    return pafs.S3FileSystem(
        access_key=how.get("access.key"),
        secret_key=how.get("secret.key"),
        session_token=how.get("session.token"),
        region=how.get("endpoint.region"),
        endpoint_override=endpoint.rpartition("//")[2] or None,
        scheme="http" if plain else "https",
    )


def _by_value(function: Callable) -> Callable:
    """A copy of a module's function that is sent to tasks as it is, not by its name."""
    from types import FunctionType

    return FunctionType(function.__code__, {"__builtins__": __builtins__}, function.__name__)


def hidden(name):
    """Names of markers, which no listing shows: of a column."""
    marks = name.startswith("_") & ~name.contains("=")
    return marks | name.startswith(".") | name.endswith("._COPYING_")


def listed(
    spark: SparkSession, how: dict[str, str], folder: str, first: str = ""
) -> DataFrame:
    """``path``, ``length`` and ``modified_at`` of every file below ``folder``; right in it
    only files and folders whose names begin with ``first``."""
    out = scratch_dir(spark, "listing")
    open_fs, n_rows = _by_value(_opened), _ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa
        import pyarrow.fs as pafs

        fs = open_fs(how)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                found = fs.get_file_info(pafs.FileSelector(path, allow_not_found=True))
                for low in range(0, len(found), n_rows):
                    some = found[low : low + n_rows]
                    times = [x.mtime_ns and x.mtime_ns // 1_000_000 for x in some]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([x.path for x in some], pa.string()),
                            pa.array([x.type == pafs.FileType.Directory for x in some]),
                            pa.array([x.size or 0 for x in some], pa.int64()),
                            pa.array(times, pa.int64()),
                        ],
                        names=["path", "is_folder", "length", "modified_ms"],
                    )

    from pyspark.sql import types as T

    frontier = small_frame(spark, [(folder,)], T.StructType([T.StructField("path", T.StringType())]))
    name = F.substring_index("path", "/", -1)
    levels: list[str] = []
    while True:
        level = frontier.mapInArrow(run, _FOUND).filter(~hidden(name))
        if first and not levels:
            level = level.filter(name.startswith(first))
        levels.append(f"{out}/level-{len(levels)}")
        level.write.parquet(levels[-1])
        folders = spark.read.schema(_FOUND).parquet(levels[-1]).filter("is_folder").select("path")
        n = folders.count()
        if not n:
            break
        tasks = min(shuffle_tasks(spark), -(-n // FOLDERS_PER_TASK))
        frontier = folders.repartition(max(1, tasks), "path")
    files = spark.read.schema(_FOUND).parquet(*levels).filter("NOT is_folder")
    return files.select("path", "length", F.timestamp_millis("modified_ms").alias("modified_at"))


_FOOTER = "path string, problem string, n_rows long, position int, column_name string, dtype string"
_FOOTER += ", most long, unit string, complete boolean"


def footers(
    spark: SparkSession,
    how: dict[str, str],
    files: DataFrame,
    keep: str = "path",
    column: str | None = None,
) -> DataFrame:
    """A row per column of every Parquet file of ``files`` (``path`` and what else ``keep``
    lists): its place and type, as Spark reads it, and the file's rows.

    The type is NULL where only Spark can tell. A file that is no Parquet file has one row
    with the ``problem``. For ``column``, if it is a whole number, date or time, ``most``
    is its greatest value as the footer has it (``unit``: of a time, ms, us or ns), and
    ``complete`` whether the footer tells of all its values.
    """
    open_fs = _by_value(_opened)
    kept = [c.strip() for c in keep.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import json

        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyspark.sql import types as T
        from pyspark.sql.pandas.types import from_arrow_type

        fs = open_fs(how)
        wider = {"uint8": "smallint", "uint16": "int", "uint32": "bigint"}
        wider["uint64"] = "decimal(20,0)"

        def kinds(meta, schema) -> list[tuple]:
            known = {}
            text = (meta.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
            if text:
                fields = T.StructType.fromJson(json.loads(text)).fields
                known = {f.name: f.dataType.simpleString() for f in fields}
            old_times = {
                meta.schema.column(k).path.split(".", 1)[0]
                for k in range(len(meta.schema))
                if meta.schema.column(k).physical_type == "INT96"
            }
            out = []
            for k, field in enumerate(schema):
                kind = known.get(field.name) or wider.get(str(field.type))
                nanos = "[ns" in str(field.type)
                if not kind and field.name not in old_times and not nanos:
                    try:
                        kind = from_arrow_type(field.type, True).simpleString()
                    except Exception:  # a type that only Spark's reader knows
                        kind = None
                out.append((k, field.name, kind))
            return out

        def greatest(meta, schema):
            """Of the wanted column, over all row groups."""
            most, unit, complete = None, None, True
            kind = schema.field(column).type
            if not (pa.types.is_integer(kind) or pa.types.is_date32(kind)):
                if not pa.types.is_timestamp(kind):
                    return None, None, False
                unit = kind.unit
            where = [k for k in range(len(meta.schema)) if meta.schema.column(k).path == column]
            if len(where) != 1 or meta.schema.column(where[0]).physical_type == "INT96":
                return None, None, False
            for g in range(meta.num_row_groups):
                chunk = meta.row_group(g).column(where[0])
                stats = chunk.statistics
                if stats is not None and stats.has_min_max:
                    value = int(stats.max_raw)
                    most = value if most is None else max(most, value)
                elif chunk.num_values and not (
                    stats is not None
                    and stats.has_null_count
                    and stats.null_count == meta.row_group(g).num_rows
                ):
                    complete = False
            return most, unit, complete

        for batch in batches:
            given = batch.to_pylist()
            rows = []
            for row in given:
                try:
                    with fs.open_input_file(row["path"]) as source:
                        file = pq.ParquetFile(source)
                        meta, schema = file.metadata, file.schema_arrow
                        n = meta.num_rows
                        for k, name, kind in kinds(meta, schema):
                            top = greatest(meta, schema) if name == column else (None, None, None)
                            rows.append((row, (None, n, k, name, kind, *top)))
                        if not len(schema):
                            rows.append((row, (None, n, None, None, None, None, None, None)))
                except (pa.ArrowInvalid, OSError, KeyError, ValueError) as error:
                    why = (str(error).splitlines() or [type(error).__name__])[0]
                    rows.append((row, (why, None, None, None, None, None, None, None)))
            if rows:
                first = [
                    pa.array([r[0][c] for r in rows], batch.schema.field(c).type) for c in kept
                ]
                types = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string()]
                types += [pa.int64(), pa.string(), pa.bool_()]
                values = zip(*(r[1] for r in rows), strict=True)
                rest = [pa.array(list(v), t) for v, t in zip(values, types, strict=True)]
                names = ["problem", "n_rows", "position", "column_name", "dtype"]
                names += ["most", "unit", "complete"]
                yield pa.RecordBatch.from_arrays([*first, *rest], names=[*kept, *names])

    chosen = files.select(*kept)
    before = ", ".join(f"`{c}` {chosen.schema[c].dataType.simpleString()}" for c in kept)
    tasks = min(shuffle_tasks(spark), -(-chosen.count() // FILES_PER_TASK))
    dealt = chosen.repartition(max(1, tasks), "path")
    return dealt.mapInArrow(run, f"{before}, {_FOOTER.split(', ', 1)[1]}")
