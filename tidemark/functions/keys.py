"""Object keys, URIs and the names of sync files."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from urllib.parse import quote

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: <yyyy_mm_dd>_<epoch ms>_<part>.parquet
SYNC_FILE = r"^\d{4}_\d{2}_\d{2}_(\d+)_(\d+)\.parquet$"


def uri(root: str, *parts: str) -> str:
    """Join a root URI and key parts with single slashes; empty parts vanish."""
    kept = [p.strip("/") for p in parts if p.strip("/")]
    return "/".join([root.rstrip("/") if root != "/" else "", *kept])


def path_segment(name: str) -> str:
    """A stream name as one path segment.

    Names starting with ``_`` or ``.`` are escaped too: file listings skip them.
    """
    text = quote(name, safe="")
    if text[:1] in ("_", "."):
        text = f"%{ord(text[0]):02X}{text[1:]}"
    return text


def object_key(path: Column | str, prefix: str = "") -> Column:
    """``prefix/basename(path)``; an empty prefix adds no slash."""
    name = F.substring_index(path, "/", -1)
    prefix = prefix.rstrip("/")
    return F.concat(F.lit(prefix + "/"), name) if prefix else name


def has_extension(name: Column | str, extensions: Iterable[str] | str) -> Column:
    """True where a name ends with one of the extensions (case-sensitive)."""
    column = F.col(name) if isinstance(name, str) else name
    if isinstance(extensions, str):
        extensions = (extensions,)
    return reduce(
        lambda found, ext: found | column.endswith(ext), extensions, F.lit(False)
    )


def decoded(column: Column) -> Column:
    """Undo the percent-encoding of ``_metadata`` paths; a plus sign stays one."""
    return F.url_decode(F.replace(column, F.lit("+"), F.lit("%2B")))


def sync_epoch(file_name: Column | str) -> Column:
    """Epoch milliseconds in a sync file's name; NULL for any other name."""
    return F.regexp_extract(file_name, SYNC_FILE, 1).try_cast("bigint")


def utc_time(epoch_ms: Column | str) -> Column:
    """Epoch milliseconds as a UTC ``timestamp_ntz``, whatever the session zone."""
    ms = F.col(epoch_ms) if isinstance(epoch_ms, str) else epoch_ms
    seconds = ms.cast("decimal(18,0)") * F.lit("0.001").cast("decimal(4,3)")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
