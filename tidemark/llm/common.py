"""What the operators of this subpackage share.

Every operator takes the columns it names from its input and nothing else, and those that
hand on whole rows set the others apart, so further columns, whatever their names, do no
harm.
"""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from functools import cache, lru_cache
from pathlib import Path
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.keys import uri
from tidemark.session import scratch_dir

# Rows of one Arrow batch, so that a batch of very long texts still fits a worker.
BATCH_ROWS = 1000
ROWS_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
# Distinct words a worker remembers before it starts anew.
WORDS_KEPT = 250_000
# Bytes of texts that are worked on at once where every word makes several numbers.
TEXT_AT_ONCE = 512 << 10


def prepare(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to BATCH_ROWS rows, and send this package to
    the executors, where it may not be installed."""
    if int(spark.conf.get(ROWS_CONF)) > BATCH_ROWS:
        spark.conf.set(ROWS_CONF, str(BATCH_ROWS))
    context = spark.sparkContext
    if getattr(context, "_tidemark_sent", None) is None:
        package, data = Path(__file__).resolve().parent.parent, io.BytesIO()
        with zipfile.ZipFile(data, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        context._tidemark_sent = uri(scratch_dir(spark, "package"), "tidemark.zip")
        put(context._tidemark_sent, data.getvalue())
        context.addPyFile(context._tidemark_sent)


def stash(df: DataFrame, label: str) -> DataFrame:
    """Write to the folder all executors share and read back: lineage ends there."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def apart(docs: DataFrame, *used: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with all columns but ``used`` under names that no operator gives to its
    own, and what brings back the columns as they came."""
    names = [c if c in used else f"column {k}" for k, c in enumerate(docs.columns)]

    def restore(df: DataFrame) -> DataFrame:
        return df.select(*(f"`{n}`" for n in names)).toDF(*docs.columns)

    return docs.toDF(*names), restore


def crc_rest(column: str, modulus: int):
    """crc32 of a column's text, modulo ``modulus``; of the empty text for NULL."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % modulus


# --- words -------------------------------------------------------------------


def word_list(text: str | None, lower: bool = True) -> list[bytes]:
    """Words between the bytes 09-0D and 20, as UTF-8; only A-Z are lower-cased."""
    data = (text or "").encode("utf-8", "surrogatepass")
    return (data.lower() if lower else data).split()


_REMEMBERS: list[Callable[[], None]] = []


def remembers(forget: Callable[[], None]) -> None:
    """Say whose memory the task at hand uses: operators of a session share their workers,
    and what the one before remembered is let go."""
    if _REMEMBERS and _REMEMBERS[0] != forget:
        _REMEMBERS.pop()()
    if not _REMEMBERS:
        _REMEMBERS.append(forget)


class _Hashes(dict):
    def __missing__(self, word):
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _Hashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash per word."""
    remembers(_HASHES.clear)
    if len(_HASHES) > WORDS_KEPT:
        _HASHES.clear()
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def mix(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers, one to one."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each run of ``size`` items; of all of them if there are fewer."""
    n = len(hashes)
    size = min(size, n)
    if not n:
        return hashes
    out = np.full(n - size + 1, size, np.uint64)
    for k in range(size):
        out = mix(out ^ hashes[k : n - size + 1 + k])
    return out


# --- files in the shared folder ----------------------------------------------


@cache
def _filesystem(scheme: str, host: str):
    if scheme in ("", "file"):
        return pafs.LocalFileSystem()
    scheme = "s3" if scheme == "s3a" else scheme  # Hadoop's name for it
    return pafs.FileSystem.from_uri(f"{scheme}://{host}/")[0]


def opened(location: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI, and the path in it."""
    parts = urlparse(location)
    path = parts.path if parts.scheme in ("", "file", "hdfs") else parts.netloc + parts.path
    return _filesystem(parts.scheme, parts.netloc), path


def put(location: str, data: bytes | memoryview) -> None:
    """Write one object under a temporary name, then give it its own."""
    fs, path = opened(location)
    fs.create_dir(os.path.dirname(path), recursive=True)
    name = f"{path}.{uuid.uuid4().hex}.tmp"
    with fs.open_output_stream(name, compression=None) as out:
        out.write(data)
    fs.move(name, path)


def _forget(path: str) -> None:
    try:
        os.unlink(path)
    except OSError:
        pass


# Objects a worker maps at once: systems allow some 65,000 maps per process.
MAPS_KEPT = 8192


@lru_cache(MAPS_KEPT)
def mapped(location: str, kind: str) -> np.ndarray:
    """An array of a shared object, memory-mapped; those not used lately are let go.

    A folder that is no local mount is read through a private copy, whose name is
    removed once it is mapped: the space goes with the worker.
    """
    fs, path = opened(location)
    size = fs.get_file_info(path).size
    if not size:
        return np.zeros(0, kind)
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(path, kind, "r")
    handle, copy = tempfile.mkstemp()
    with os.fdopen(handle, "wb") as out, fs.open_input_stream(path, compression=None) as data:
        while block := data.read(1 << 24):
            out.write(block)
    array = np.memmap(copy, kind, "r")
    _forget(copy)
    return array


# --- batches -----------------------------------------------------------------


def columns(batch: pa.RecordBatch, *names: str) -> list[list]:
    return [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]


def parts(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """A batch in stretches of rows that have TEXT_AT_ONCE bytes of one column, but for
    what the last row goes beyond."""
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0)
    sizes = sizes.to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(sizes) - sizes) // TEXT_AT_ONCE
    cuts = [*np.flatnonzero(np.diff(part, prepend=-1)).tolist(), len(part)]
    for low, high in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(low, high - low)


def pooled(batches: Iterator[pa.RecordBatch], text: str, size: int) -> Iterator[pa.Table]:
    """Batches joined until they hold ``size`` bytes of one column."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.column(batch.schema.get_field_index(text)).nbytes
        if n >= size:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)

