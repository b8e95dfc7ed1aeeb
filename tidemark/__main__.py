"""Run a workflow from the command line, also under spark-submit.

    python -m tidemark discover --schema SALES
    python -m tidemark migrate s3a://lake/bronze --schema SALES --stream ORDERS
    python -m tidemark show s3a://lake/in/ORDERS --order-by ORDER_ID
    python -m tidemark list s3a://lake --prefix raw/
    python -m tidemark land-folders file:/data/raw s3a://lake --prefix raw/trips

The source is the Oracle database of the ORACLE_* variables, or with ``--lake``
a root of ``<schema>/<stream>.parquet``. An S3-compatible store is taken from
S3_ENDPOINT, AWS_ACCESS_KEY_ID and AWS_SECRET_ACCESS_KEY where they are set.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame

import tidemark as tm
from tidemark.plans import land_folders, migrate, read_back


def _arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tidemark")
    parser.add_argument("--rows", type=int, default=20, help="rows of a preview")
    commands = parser.add_subparsers(dest="command", required=True)

    source = argparse.ArgumentParser(add_help=False)
    source.add_argument("--schema", action="append", default=[])
    source.add_argument("--lake", help="read from this lake root, not from Oracle")

    commands.add_parser("discover", parents=[source])
    moving = commands.add_parser("migrate", parents=[source])
    moving.add_argument("root")
    moving.add_argument("--stream", action="append", help="default: all")
    moving.add_argument("--cursor", action="append", default=[], metavar="STREAM=COLUMN")
    moving.add_argument("--split-by", action="append", default=[], metavar="STREAM=KEY")
    moving.add_argument("--tasks", type=int, default=64, help="readers per split table")
    moving.add_argument("--full-refresh", action="store_true")
    moving.add_argument("--parallel", type=int, default=4)

    showing = commands.add_parser("show")
    showing.add_argument("folder")
    showing.add_argument("--key", default="", help="default: the newest sync")
    showing.add_argument("--order-by", required=True)

    listing = commands.add_parser("list")
    listing.add_argument("root")
    listing.add_argument("--prefix", default="")
    listing.add_argument("--extension", action="append")

    folders = commands.add_parser("land-folders")
    folders.add_argument("raw_root")
    folders.add_argument("out_root")
    folders.add_argument("--prefix", default="raw")
    return parser.parse_args(argv)


def _source(given: argparse.Namespace) -> tm.LakeSource | tm.JdbcSource:
    schemas = tuple(given.schema)
    if given.lake:
        return tm.LakeSource(given.lake, schemas)
    return tm.JdbcSource.oracle_from_env(schemas)


def _store() -> dict[str, str]:
    names = ("S3_ENDPOINT", "AWS_ACCESS_KEY_ID", "AWS_SECRET_ACCESS_KEY")
    values = [os.environ.get(n) for n in names]
    return tm.store_conf(*values) if all(values) else {}


def main(argv: Sequence[str] | None = None) -> list[DataFrame]:
    """Run one command, print its results and return them."""
    given = _arguments(argv)
    spark = tm.build_session(f"tidemark {given.command}", conf=_store())
    if given.command == "discover":
        found = tm.discover(spark, _source(given))
        results = [found.orderBy("schema_name", "stream", "ordinal")]
    elif given.command == "migrate":
        cursors, keys = (
            dict(pair.split("=", 1) for pair in pairs)
            for pairs in (given.cursor, given.split_by)
        )
        log = migrate(
            spark,
            _source(given),
            given.root,
            given.stream,
            cursors,
            given.full_refresh,
            given.parallel,
            keys,
            given.tasks,
        )
        results = [log.drop("schema_json", "error").orderBy("stream")]
    elif given.command == "show":
        parts = read_back(spark, given.folder, given.order_by, given.key, given.rows)
        results = [parts[name] for name in ("head", "info", "shape")]
    elif given.command == "list":
        found = tm.list_objects(
            spark, given.root, given.prefix, extensions=given.extension
        )
        results = [found.orderBy("object_name")]
    else:
        log = land_folders(spark, given.raw_root, given.out_root, given.prefix)
        results = [log.select("stream", "sync_ms", "n_rows").orderBy("stream")]
    for df in results:  # a preview is as long as asked for, the rest is shown whole
        df.show(df.count(), truncate=False)
    return results


if __name__ == "__main__":
    main()
