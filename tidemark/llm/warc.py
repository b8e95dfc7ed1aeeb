"""Pages as WARC archives, and back.

Records are sorted by page_id and cut into shards by the bytes that come before them, so
the same pages make the same files, however they lie in the input. Each task writes a shard
into gzip members, one per record, and starts a new file when the compressed bytes pass a
bound. Equal
payloads are stored once: the first page (the smallest page_id) holds the response,
the others a revisit that points at it. Tasks write under names of their attempt; the
manifest, written after them, names the files of the attempts that succeeded, and those
are then given their final names. An archive is complete once ``manifest`` exists.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.frames import small_frame
from tidemark.llm.common import columns, opened, prepare, scratch_dir, stash, uri
from tidemark.session import MOST_READERS

# Html bytes of a shard, at least, and shards at most; compressed bytes after which a file
# is closed, at least, and so many files' worth of html in a shard.
HTML_PER_TASK, MOST_SHARDS = 16 << 20, 20_000
FILE_BYTES, FILES_PER_TASK = 1 << 20, 16
# Ranges of page_ids whose bytes are summed to find the shards, and finer ones of one that
# holds too many. Sums of all ranges come to the driver.
RANGES, FINER = 1 << 16, 1 << 8
_RANGE = T.StructType([T.StructField("range", T.LongType())])
_SHARD = T.StructType([*_RANGE, T.StructField("shard", T.IntegerType())])
ID = "_tidemark_warc_"
# Record headers.
VERSION = "WARC/1.1"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Names of records are derived from page_id and payload, so that they can be repeated.
NAMES = uuid.UUID("6f1f0a52-6a6b-5d0e-9c59-0d7f5b0c3a11")
DATE = "1970-01-01T00:00:00Z"
READ_BYTES = 1 << 20


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_name(page_id: int | None, sha1: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMES, f'{page_id}/{sha1}')}>"


def _header(text: str) -> str:
    """A value that stays on its line."""
    return " ".join(text.split()) or "-"


def record(page_id, url, payload: bytes, first, date: str = DATE) -> bytes:
    """One record; ``first`` is the page that holds an equal payload, or ``...``."""
    sha1 = digest(payload)
    kind = "response" if first is ... else "revisit"
    body = b"" if first is not ... else b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n" % (
        len(payload)
    )
    body += payload if first is ... else b""
    lines = [
        VERSION,
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_name(page_id, sha1) if first is ... else _again(page_id, sha1)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {_header(url or '')}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{sha1}",
        f"WARC-Block-Digest: sha1:{digest(body)}",
        f"X-Page-ID: {'' if page_id is None else page_id}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if first is not ...:
        lines += [
            f"WARC-Profile: {REVISIT}",
            f"WARC-Refers-To: {record_name(first, sha1)}",
            f"X-Refers-To-Page-ID: {'' if first is None else first}",
        ]
    lines.append(f"Content-Length: {len(body)}")
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + body + b"\r\n\r\n"


def _again(page_id, sha1: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMES, f'{page_id}/{sha1}/revisit')}>"


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _finest(low: int, high: int, ranges: int) -> int:
    """Low bits to leave out of page_ids for so many ranges at most."""
    shift = 0
    while (high >> shift) - (low >> shift) >= ranges:
        shift += 1
    return shift


def shards(rows: DataFrame) -> tuple[Callable[[DataFrame], DataFrame], int, int]:
    """What adds a page's ``shard`` by its page_id, the number of shards, and the html
    bytes of one, for ``rows`` (page_id, html).

    Bytes are summed exactly per range of page_ids, of a fixed power of two in width, and
    shards end where the running sum passes a multiple of their size; a range that holds
    more than two shards is summed by finer ranges. A page_id by itself is not cut: rows
    that share one are in one shard.
    """
    spark = rows.sparkSession
    size = F.octet_length("html").cast("long")
    low, high, total = rows.agg(F.min("page_id"), F.max("page_id"), F.sum(size)).first()
    each = max(HTML_PER_TASK, -(-(total or 0) // MOST_SHARDS))
    if low is None:
        return lambda df: df.withColumn("shard", F.lit(0)), 1, each
    known = F.coalesce("page_id", F.lit(low))  # pages without an id come first
    shift = _finest(low, high, RANGES)
    levels: list[tuple[int, list[tuple[int, int]]]] = []  # (range, bytes), by width
    some = rows.select(known.alias("page_id"), size.alias("size"))
    while True:
        sums = some.groupBy(F.shiftright("page_id", shift).alias("range")).agg(F.sum("size"))
        found = [(r[0], r[1] or 0) for r in sums.collect()]
        heavy = [r for r, n in found if shift and n > 2 * each]
        levels.append((shift, [(r, n) for r, n in found if not (shift and n > 2 * each)]))
        if not heavy:
            break
        wide = small_frame(spark, [(r,) for r in heavy], _RANGE)
        at = F.shiftright("page_id", shift).alias("range")
        some = some.withColumn("range", at).join(F.broadcast(wide), "range").drop("range")
        shift = max(0, shift - FINER.bit_length() + 1)
    # all ranges in order of page_id; no two of them share one
    order = sorted((r << s, k, r, n) for k, (s, level) in enumerate(levels) for r, n in level)
    before, numbers = 0, {}
    held: list[list[tuple[int, int]]] = [[] for _ in levels]
    for _, k, r, n in order:
        held[k].append((r, numbers.setdefault(before // each, len(numbers))))
        before += n

    def assign(df: DataFrame) -> DataFrame:
        names = df.columns
        out = df.withColumn(ID, F.coalesce("page_id", F.lit(low)))
        found = []
        for k, (s, _) in enumerate(levels):
            # RANGES rows at most, and FINER for each range that holds too many
            table = small_frame(spark, held[k], _SHARD).toDF(f"{ID}r{k}", f"{ID}s{k}")
            out = out.withColumn(f"{ID}r{k}", F.shiftright(ID, s))
            out = out.join(F.broadcast(table), f"{ID}r{k}", "left")
            found.append(f"{ID}s{k}")
        return out.select(*names, F.coalesce(*found).alias("shard"))

    return assign, len(numbers), each


def write(pages: DataFrame, root: str, least_bytes: int = 0, date: str = DATE) -> DataFrame:
    """Write ``pages`` (page_id, url, html) below ``root``; returns the manifest
    (file, records, bytes).

    Only payloads of at least ``least_bytes`` are stored once. NULL html is an empty
    payload; a NULL page_id sorts before all others. Of rows with equal page_id and
    payload the first is the response. ``date`` is that of all records: pages have none of
    their own. Equal pages make equal files, whatever their order and partitions.
    """
    spark = pages.sparkSession
    prepare(spark)
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"))
    assign, n, html_bytes = shards(rows)
    file_bytes = max(FILE_BYTES, html_bytes // FILES_PER_TASK)

    # which pages revisit: only digests and ids are shuffled, equal ones met beforehand
    sums = rows.filter(F.octet_length("html") >= least_bytes).select(
        "page_id", F.unhex(F.sha1("html")).alias("sha1")
    )
    firsts = sums.groupBy("sha1").agg(
        F.min_by("page_id", F.coalesce("page_id", F.lit(-(1 << 63)))).alias("first"),
        F.count("*").alias("n"),
    )
    again = (
        sums.join(firsts.filter("n > 1").drop("n"), "sha1")
        .groupBy("page_id", "sha1", "first")
        .count()
        .drop("count")
    )
    marks = stash(again, "revisits").select(
        "page_id",
        F.lit(None).cast("string").alias("url"),
        F.col("sha1").alias("html"),
        F.lit(0).alias("kind"),
        "first",
    )
    # a page's mark comes just before it, in the one shuffle that sorts the pages
    both = rows.select(
        "page_id", "url", "html", F.lit(1).alias("kind"), F.lit(None).cast("long").alias("first")
    ).unionByName(marks)
    dealt = assign(both).repartitionById(n, "shard")
    dealt = dealt.sortWithinPartitions("page_id", "kind", "html", "url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        stem = f"part-{context.partitionId():05d}"
        tag = f"{context.taskAttemptId()}.tmp"
        marks: dict[bytes, int | None] = {}
        at, seen = ..., set()
        out, number, records, held = None, 0, 0, 0

        def closed() -> pa.RecordBatch:
            out.close()
            name = f"{stem}-{number:04d}.warc.gz"
            return pa.RecordBatch.from_pydict(
                {
                    "file": [name],
                    "written": [f"{name}.{tag}"],
                    "records": pa.array([records], pa.int64()),
                    "bytes": pa.array([held], pa.int64()),
                }
            )

        for batch in batches:
            for page_id, url, payload, kind, first in zip(
                *columns(batch, "page_id", "url", "html", "kind", "first"), strict=True
            ):
                if at is ... or page_id != at:
                    at, marks, seen = page_id, {}, set()
                if not kind:
                    marks[payload] = first
                    continue
                key = hashlib.sha1(payload).digest()
                revisit = key in marks and (marks[key] != page_id or key in seen)
                seen.add(key)
                if out is None:
                    fs, path = opened(uri(root, f"{stem}-{number:04d}.warc.gz.{tag}"))
                    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
                    out = fs.open_output_stream(path, compression=None)
                first = marks[key] if revisit else ...
                data = _gzip(record(page_id, url, payload, first, date))
                out.write(data)
                records += 1
                held += len(data)
                if held >= file_bytes:
                    yield closed()
                    out, number, records, held = None, number + 1, 0, 0
        if out is not None:
            yield closed()

    made = "file string, written string, records long, bytes long"
    done = stash(dealt.mapInArrow(run, made), "warc-files")

    def commit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, written in zip(*columns(batch, "file", "written"), strict=True):
                fs, path = opened(uri(root, written))
                final = opened(uri(root, name))[1]
                if fs.get_file_info(path).is_file:
                    fs.move(path, final)
                elif not fs.get_file_info(final).is_file:  # an earlier attempt's, else lost
                    raise FileNotFoundError(f"{name}: neither written nor committed")
            yield batch.select(["file", "records", "bytes"])

    manifest = done.mapInArrow(commit, "file string, records long, bytes long")
    manifest.write.parquet(uri(root, "manifest"))
    return spark.read.schema(manifest.schema).parquet(uri(root, "manifest"))


class _Members:
    """The records of an archive, one gzip member after the other."""

    def __init__(self, stream):
        self.stream, self.rest = stream, b""

    def __iter__(self) -> Iterator[bytes]:
        while True:
            packer, out = zlib.decompressobj(31), []
            while not packer.eof:
                data = self.rest or self.stream.read(READ_BYTES)
                self.rest = b""
                if not data:
                    if out:
                        raise ValueError("the archive is cut off")
                    return
                out.append(packer.decompress(data))
            self.rest = packer.unused_data
            yield b"".join(out)


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a record."""
    head, _, rest = member.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    return headers, rest[: int(headers["Content-Length"])]


def read(manifest: DataFrame, root: str) -> DataFrame:
    """Every record of the archives that the manifest names, digests checked.

    ``payload`` is NULL for revisits; their length and digest are those of the payload
    they stand for.
    """
    prepare(manifest.sparkSession)

    def number(text: str) -> int | None:
        return int(text) if text else None

    def rows(name: str):
        fs, path = opened(uri(root, name))
        with fs.open_input_stream(path, compression=None) as stream:
            for member in _Members(stream):
                h, block = parse(member)
                if digest(block) != h["WARC-Block-Digest"].removeprefix("sha1:"):
                    raise ValueError(f"{name}: a record's digest is wrong")
                kind = h["WARC-Type"]
                payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
                sha1 = h["WARC-Payload-Digest"].removeprefix("sha1:")
                size = int(h["X-Payload-Length"])
                if payload is not None:
                    size, sha1 = len(payload), digest(payload)
                yield (
                    number(h["X-Page-ID"]),
                    h["WARC-Target-URI"],
                    size,
                    sha1,
                    kind,
                    number(h.get("X-Refers-To-Page-ID", "")),
                    payload,
                )

    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = "page_id url payload_bytes payload_digest record_type refers_to payload".split()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(held: list) -> pa.RecordBatch:
            arrays = [pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            for name in columns(batch, "file")[0]:
                held, size = [], 0
                for row in rows(name):
                    held.append(row)
                    size += row[2]
                    if len(held) >= 1000 or size >= 16 << 20:
                        yield made(held)
                        held, size = [], 0
                if held:
                    yield made(held)

    n = min(MOST_READERS, max(1, manifest.count()))
    files = manifest.select("file").repartition(n, "file")
    return files.mapInArrow(
        run,
        "page_id long, url string, payload_bytes long, payload_digest string,"
        " record_type string, refers_to long, payload binary",
    )


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` and say what the archives hold, page by page."""
    root = scratch_dir(pages.sparkSession, "warc")
    return read(write(pages, root), root).drop("url", "payload")


def sql() -> str:
    """``round_trip`` of pages in another engine's words: 40 bits give eight letters."""
    bits = "CAST('0x' || substr(sha, 10 * (i // 8) + 1, 10) AS UBIGINT)"
    letter = f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(({bits} >> (35 - 5 * (i % 8))) & 31 AS INT) + 1, 1)"
    return (
        "WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),"
        " d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,"
        " sha1(html) AS sha, min(page_id) OVER (PARTITION BY html) AS first FROM p)"
        " SELECT page_id, payload_bytes,"
        f" array_to_string(list_transform(range(32), lambda i: {letter}), '') AS payload_digest,"
        " CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,"
        " CASE WHEN page_id <> first THEN first END AS refers_to FROM d"
    )
