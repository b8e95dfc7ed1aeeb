"""Extract relational tables and land them in a data lake with Spark.

Every operator takes and returns DataFrames; rows stay on the executors.
"""

from tidemark.config import JdbcSource, LakeSource, store_conf
from tidemark.errors import (
    CursorRefused,
    NoData,
    SchemaDrift,
    SyncFailed,
    UnknownStream,
)
from tidemark.functions.keys import has_extension, object_key, uri
from tidemark.operators.cache import StreamCache
from tidemark.operators.profile import (
    column_list,
    cursor_profile,
    preview_head,
    profile_info,
    require_cursor,
    stream_shape,
    stream_shapes,
)
from tidemark.operators.raw import land_raw
from tidemark.operators.reconcile import (
    reconcile,
    reconcile_many,
    reconcile_ranges,
)
from tidemark.operators.sinks import (
    land,
    read_csv,
    read_table,
    write_csv,
    write_table,
)
from tidemark.operators.snapshots import (
    current,
    latest_snapshot,
    latest_sync_files,
    snapshot_history,
    sync_file_history,
)
from tidemark.operators.sync import StreamPlan, compact, configured_catalog, sync
from tidemark.operators.synclog import read_log
from tidemark.session import build_session, scratch_dir
from tidemark.sources.catalog import discover, select
from tidemark.sources.jdbc import (
    Split,
    Stride,
    balanced_cuts,
    key_split,
    range_split,
    rowid_split,
)
from tidemark.sources.lake import list_objects, read_lake
from tidemark.sources.streams import (
    high_water_mark,
    read_incremental,
    read_stream,
    read_streams,
    source_mark,
    stream_mark,
)
from tidemark.streaming.pickup import pickup_new_files, refused_files

__all__ = [
    "CursorRefused",
    "JdbcSource",
    "LakeSource",
    "NoData",
    "SchemaDrift",
    "Split",
    "StreamCache",
    "StreamPlan",
    "Stride",
    "SyncFailed",
    "UnknownStream",
    "balanced_cuts",
    "build_session",
    "column_list",
    "compact",
    "configured_catalog",
    "current",
    "cursor_profile",
    "discover",
    "has_extension",
    "high_water_mark",
    "key_split",
    "land",
    "land_raw",
    "latest_snapshot",
    "latest_sync_files",
    "list_objects",
    "object_key",
    "pickup_new_files",
    "preview_head",
    "profile_info",
    "range_split",
    "read_csv",
    "read_incremental",
    "read_lake",
    "read_log",
    "read_stream",
    "read_streams",
    "read_table",
    "reconcile",
    "reconcile_many",
    "reconcile_ranges",
    "refused_files",
    "require_cursor",
    "rowid_split",
    "scratch_dir",
    "select",
    "snapshot_history",
    "source_mark",
    "store_conf",
    "stream_mark",
    "stream_shape",
    "stream_shapes",
    "sync",
    "sync_file_history",
    "uri",
    "write_csv",
    "write_table",
]
