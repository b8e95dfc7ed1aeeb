"""Listings, catalogs, raw folders, sync files and caches."""

import glob
import os
import re
import shutil
from datetime import date, datetime
from decimal import Decimal
from types import SimpleNamespace

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import tidemark as tm
from tidemark.operators import ledger, synclog
from tidemark.functions.cursors import from_text
from tidemark.sources import catalog, lake, streams
from tidemark.session import shared_dir
from tidemark.sources.lake import glob_escape

LAKE = tm.LakeSource("/root/testdata", ("sf0.001",))


def names(df):
    return sorted(r.object_name for r in df.select("object_name").collect())


@pytest.fixture
def tree(tmp_path):
    for name in ("a b/x+y%é.parquet", "a b/z.csv", "deep/er/one.parquet", "top.txt", "_SUCCESS"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"12345")
    return tmp_path


@pytest.mark.parametrize("shape", ["file:{}", "file://{}/", "{}", "file:///{}"])
def test_listing(spark, tree, shape):
    root = shape.format(tree)
    want = ["a b/x+y%é.parquet", "a b/z.csv", "deep/er/one.parquet", "top.txt"]
    found = tm.list_objects(spark, root)
    assert names(found) == want
    assert {r.length for r in found.collect()} == {5}
    assert names(tm.list_objects(spark, root, "a b/")) == want[:2]
    assert names(tm.list_objects(spark, root, "a b/x")) == want[:1]
    assert names(tm.list_objects(spark, root, "de")) == want[2:3]
    assert names(tm.list_objects(spark, root, "none/of/it")) == []
    assert names(tm.list_objects(spark, root, "zzz")) == []
    assert names(tm.list_objects(spark, root, extensions=(".csv", ".txt"))) == [
        "a b/z.csv",
        "top.txt",
    ]
    assert names(tm.list_objects(spark, root, extensions=())) == []
    assert names(tm.list_objects(spark, root, glob="o*.parquet")) == want[2:3]


def test_missing_and_empty_roots_differ(spark, tmp_path):
    with pytest.raises(tm.NoData):
        tm.list_objects(spark, f"file:{tmp_path}/none")
    (tmp_path / "empty").mkdir()
    assert tm.list_objects(spark, f"file:{tmp_path}/empty").count() == 0
    for path in ("none", "empty"):
        with pytest.raises(tm.NoData, match=path):
            tm.read_lake(spark, f"file:{tmp_path}", path)
    with pytest.raises(ValueError, match="absolute"):
        tm.list_objects(spark, ".")


def test_listing_reads_no_content_and_prunes(spark, tmp_path):
    for name in ("pa/x.bin", "pa/deep/y.bin", "other/z.bin", "path.bin"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"1234")
        os.utime(tmp_path / name, ns=(0, 1_700_000_000_123_456_789))
    found = tm.list_objects(spark, f"file:{tmp_path}", "pa")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "binaryFile" not in plan and not any(str(tmp_path) in f for f in found.inputFiles())
    assert names(found) == ["pa/deep/y.bin", "pa/x.bin", "path.bin"]
    assert [r.t for r in found.selectExpr("unix_millis(modified_at) t").distinct().collect()] == [
        1_700_000_000_123
    ]
    listed = [f for f in found.inputFiles()]
    seen = spark.read.parquet(*{f.rpartition("/")[0] for f in listed}).select("path").collect()
    assert not any("/other/" in r.path for r in seen)


@pytest.mark.parametrize("glob", ["o*.p?rquet", "{one,two}.parquet", "[a-o]ne.*", "[!x]ne.p*t"])
def test_globs(spark, tree, glob):
    want = ["deep/er/one.parquet"]
    assert names(tm.list_objects(spark, f"file:{tree}", glob=glob)) == want
    indexed = lake._indexed(spark, f"file:{tree}", "", glob.replace("!", "^"))
    assert names(indexed) == want


def test_both_ways_to_list_agree(spark, tree, monkeypatch):
    (tree / "deep" / "nothing é.parquet").write_bytes(b"")
    (tree / ".hidden").mkdir()
    (tree / ".hidden" / "x").write_bytes(b"1")
    (tree / "_k=1").mkdir()
    (tree / "_k=1" / "y").write_bytes(b"1")
    for prefix in ("", "a b/", "de", "deep/n", "zzz", "none/of/it"):
        own = tm.list_objects(spark, f"file:{tree}", prefix).collect()
        with monkeypatch.context() as patch:
            patch.setattr(lake, "opener", lambda *_: None)
            other = tm.list_objects(spark, f"file:{tree}", prefix).collect()
        assert {(r.object_name, r.length) for r in own} == {(r.object_name, r.length) for r in other}
        times = {r.object_name: r.modified_at for r in own}
        assert all(times[r.object_name] == r.modified_at for r in other if r.length)


def test_many_folders(spark, tmp_path):
    """More folders than one task lists, three levels deep."""
    for k in range(60):
        folder = tmp_path / f"a{k % 3}" / f"b{k}"
        folder.mkdir(parents=True)
        (folder / f"{k}.bin").write_bytes(b"x" * k)
    found = tm.list_objects(spark, f"file:{tmp_path}").collect()
    assert {(r.object_name, r.length) for r in found} == {
        (f"a{k % 3}/b{k}/{k}.bin", k) for k in range(60)
    }


def test_empty_objects_are_listed(spark, tree):
    (tree / "deep" / "nothing é.parquet").write_bytes(b"")
    found = {r.object_name: r.length for r in tm.list_objects(spark, f"file:{tree}").collect()}
    assert found.pop("deep/nothing é.parquet") == 0 and set(found.values()) == {5}
    only = tm.list_objects(spark, f"file:{tree}", "deep/n", extensions=(".parquet",))
    assert names(only) == ["deep/nothing é.parquet"]


def test_columns_of_all_files_are_read(spark, tmp_path):
    """Whichever footer comes first; a folder, a glob, a stream and its catalog."""
    lake = f"file:{tmp_path}/lake"
    for name, query in (("a", "SELECT 1L AS id"), ("b", "SELECT 2L AS id, 'x' AS extra")):
        spark.sql(query).coalesce(1).write.mode("append").parquet(f"{lake}/s/t")
        spark.sql(query).coalesce(1).write.parquet(f"{lake}/x/u/{name}")
    src = tm.LakeSource(lake, ("s",), suffix="")
    want = [(1, None), (2, "x")]
    assert tm.read_stream(spark, src, "t").orderBy("id").collect() == want
    assert tm.read_lake(spark, lake, "x/u/*").orderBy("id").collect() == want
    columns = tm.discover(spark, src).filter("stream = 't'").orderBy("ordinal").collect()
    assert [r.column_name for r in columns] == ["id", "extra"]
    tm.sync(spark, src, f"{lake}/out", ["t"])
    assert tm.current(spark, f"{lake}/out", "t").orderBy("id").collect() == want
    spark.sql("SELECT 'z' AS id").write.mode("append").parquet(f"{lake}/s/t")
    with pytest.raises(tm.SchemaDrift, match="id: "):
        tm.read_stream(spark, src, "t")


def test_keys(spark):
    df = spark.createDataFrame(
        [("s3a://b/x/y.parquet",), ("plain",), ("ends/",), (None,)], "p string"
    )
    assert [r[0] for r in df.select(tm.object_key("p", "raw/")).collect()] == [
        "raw/y.parquet",
        "raw/plain",
        "raw/",
        None,
    ]
    assert [r[0] for r in df.select(tm.object_key("p")).collect()] == [
        "y.parquet",
        "plain",
        "",
        None,
    ]
    assert [r[0] for r in df.select(tm.has_extension("p", ".parquet")).collect()][:3] == [
        True,
        False,
        False,
    ]
    assert tm.uri("s3a://bucket/", "/lake/", "", "table") == "s3a://bucket/lake/table"
    assert tm.uri("/", "x") == "/x"
    assert glob_escape("a{b}*") == "a\\{b\\}\\*"


def test_catalog(spark):
    catalog = tm.discover(spark, LAKE)
    assert catalog.count() == 63
    first = catalog.filter("stream = 'orders'").orderBy("ordinal").first()
    assert first == ("sf0.001", "orders", 1, "o_orderkey", "bigint")
    assert tm.select(catalog).count() == 63
    assert tm.select(catalog, ["region"]).count() == 2
    with pytest.raises(tm.UnknownStream, match="'ORDERS', 'nope'"):
        tm.select(catalog, ["orders", "ORDERS", "nope"])
    with pytest.raises(tm.UnknownStream, match="SF0.001"):
        tm.discover(spark, LAKE, schemas=["SF0.001"])
    everything = tm.discover(spark, tm.LakeSource("/root/testdata"))
    assert {r[0] for r in everything.select("schema_name").distinct().collect()} >= {
        "sf0.001",
        "sf0.01",
    }
    with pytest.raises(tm.UnknownStream, match="'ORDERS'"):
        tm.read_stream(spark, LAKE, "ORDERS")


def test_pushdown_and_pruning(spark):
    rows = tm.read_incremental(
        spark, LAKE, "orders", "o_orderdate", lo="1995-06-01", hi="1996-01-01"
    ).select("o_orderkey")
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = rows._jdf.queryExecution().explainString(mode)
    assert "GreaterThanOrEqual(o_orderdate,1995-06-01T00:00:00.000001)" in text
    assert "LessThan(o_orderdate,1996-01-01T00:00:00.000001)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text


# --- raw folders -------------------------------------------------------------


def test_raw_folders_keep_equal_basenames_apart(spark, tmp_path, orders):
    raw, out = f"file:{tmp_path}/raw", f"file:{tmp_path}/out"
    for i, folder in enumerate(["a {1}", "b"]):
        spark.range(10 * (i + 1)).coalesce(1).write.parquet(f"{raw}/{folder}")
        (part,) = glob.glob(f"{tmp_path}/raw/{glob.escape(folder)}/part-*")
        shutil.copy(part, f"{tmp_path}/raw/{folder}/same.parquet")
    (tmp_path / "raw" / "b" / "notes.txt").write_text("not parquet")
    (tmp_path / "raw" / "docs").mkdir()
    (tmp_path / "raw" / "docs" / "notes.txt").write_text("x")
    log = tm.land_raw(spark, raw, out, prefix="raw")
    assert {r.stream: r.n_rows for r in log.collect()} == {"a {1}": 20, "b": 40}
    assert tm.current(spark, f"{out}/raw", "b").count() == 40
    files = {r[0] for r in tm.current(spark, f"{out}/raw", "a {1}").select("source_file").collect()}
    assert len(files) == 2 and "a {1}/same.parquet" in files
    for _ in range(2):  # the same files again, then one more
        log = tm.land_raw(spark, raw, out, prefix="raw", mode="incremental")
        assert {r.n_rows for r in log.collect()} == {0}
    spark.range(3).coalesce(1).write.mode("append").parquet(f"{raw}/b")
    log = tm.land_raw(spark, raw, out, prefix="raw", mode="incremental")
    assert {r.stream: r.n_rows for r in log.collect()} == {"a {1}": 0, "b": 3}
    assert tm.current(spark, f"{out}/raw", "b").count() == 43
    spark.range(1).selectExpr("id", "'x' AS source_file").write.parquet(f"{raw}/c")
    with pytest.raises(tm.SyncFailed, match="source_file"):
        tm.land_raw(spark, raw, out, prefix="raw", mode="incremental")
    with pytest.raises(tm.NoData, match=".csv"):
        tm.land_raw(spark, raw, out, ext=".csv")


def test_raw_files_that_disagree_fail_by_name(spark, tmp_path):
    raw, out = f"file:{tmp_path}/raw", f"file:{tmp_path}/out"
    spark.sql("SELECT 1 AS a, 1 AS `b c`, 1 AS d").write.parquet(f"{raw}/mixed")
    spark.sql("SELECT 'x' AS a, 1L AS `b c`").write.mode("append").parquet(f"{raw}/mixed")
    spark.sql("SELECT 1 AS a").write.parquet(f"{raw}/grown")
    spark.sql("SELECT 2 AS a, 3 AS b").write.mode("append").parquet(f"{raw}/grown")
    with pytest.raises(tm.SyncFailed, match="dataset 'mixed'") as failed:
        tm.land_raw(spark, raw, out)
    for name, types in (("a", {"int", "string"}), ("b c", {"int", "bigint"})):
        (found,) = re.findall(rf"{name}: (\w+) against (\w+)", str(failed.value))
        assert set(found) == types
    assert " d: " not in str(failed.value)
    grown = tm.current(spark, out, "grown").orderBy("a").collect()
    assert [(r.a, r.b) for r in grown] == [(1, None), (2, 3)]


# --- sync files ----------------------------------------------------------------


@pytest.fixture
def sync_files(spark, tmp_path):
    """Two syncs in the file-name pattern, the newer in two parts and wider."""
    box = tmp_path / "box"
    box.mkdir()
    made = {
        "2025_12_01_1764579501178_0.parquet": "SELECT id FROM range(5)",
        "2025_12_02_1764665901178_0.parquet": "SELECT id, 'x' AS s FROM range(7)",
        "2025_12_02_1764665901178_1.parquet": "SELECT id, 'y' AS s FROM range(4)",
        "other_1_2.parquet": "SELECT 1.5 AS z",
    }
    for i, (name, sql) in enumerate(made.items()):
        spark.sql(sql).coalesce(1).write.parquet(f"file:{tmp_path}/made{i}")
        (part,) = glob.glob(f"{tmp_path}/made{i}/part-*")
        shutil.copy(part, box / name)
    (box / "deeper").mkdir()
    shutil.copy(part, box / "deeper" / "2026_01_01_1767225600000_0.parquet")
    shutil.copy(box / name, box / "2025_12_02_1764665901178_x.parquet")
    return f"file:{box}"


def test_latest_sync_files(spark, sync_files):
    latest = tm.latest_sync_files(spark, sync_files)
    assert latest.count() == 11
    plan = latest._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    assert plan.collectLeaves().apply(0).metrics().get("numFiles").get().value() == 2
    history = tm.sync_file_history(spark, sync_files).orderBy("sync_ms").collect()
    assert [(r.sync_ms, str(r.synced_at), r.n_files) for r in history] == [
        (1764579501178, "2025-12-01 08:58:21.178000", 1),
        (1764665901178, "2025-12-02 08:58:21.178000", 2),
    ]
    named = tm.read_lake(spark, sync_files, "2025_12_01_1764579501178_0.parquet")
    assert named.count() == 5


def test_parts_that_disagree_fail(spark, sync_files, tmp_path):
    spark.sql("SELECT 'a' AS id").coalesce(1).write.parquet(f"file:{tmp_path}/odd")
    (part,) = glob.glob(f"{tmp_path}/odd/part-*")
    shutil.copy(part, tmp_path / "box" / "2025_12_02_1764665901178_2.parquet")
    with pytest.raises(tm.SchemaDrift, match="1764665901178"):
        tm.latest_sync_files(spark, sync_files)


def test_a_folder_without_sync_files(spark, tmp_path):
    spark.range(3).write.parquet(f"file:{tmp_path}/plain")
    with pytest.raises(tm.NoData, match="no sync file"):
        tm.latest_sync_files(spark, f"file:{tmp_path}/plain")


def test_history_does_not_depend_on_the_zone(spark, root, orders):
    tm.land(orders.limit(3), root, "orders", sync_ms=1764579501178)
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Ho_Chi_Minh")
    try:
        rows = [
            tm.snapshot_history(spark, root, "orders", recount).first()
            for recount in (False, True)
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert rows[0] == rows[1]
    assert (str(rows[0].synced_at), rows[0].n_rows) == ("2025-12-01 08:58:21.178000", 3)


def test_readers_list_only_the_live_snapshots(spark, root, orders):
    for _ in range(3):
        tm.land(orders.coalesce(1), root, "orders")
    tm.land(orders.coalesce(1), root, "orders", mode="incremental")
    assert len(tm.current(spark, root, "orders").inputFiles()) == 2
    assert len(tm.latest_snapshot(spark, root, "orders").inputFiles()) == 1


def test_superseded_commits_cost_no_scan(spark, root, orders):
    scanned = []
    for _ in range(3):
        tm.land(orders.limit(1), root, "orders")
        tm.land(orders.limit(1), root, "orders", mode="incremental")
        scanned.append(len(synclog.live(spark, root, "orders").inputFiles()))
        assert tm.current(spark, root, "orders").count() == 2
    assert scanned == [2, 2, 2]
    assert tm.read_log(spark, root, "orders").count() == 6


# --- cache ---------------------------------------------------------------------


def test_cache(spark, tmp_path, orders):
    source = f"file:{tmp_path}/gone"
    orders.write.parquet(source)
    cache = tm.StreamCache(spark)
    kept = cache.put("2023_ORDERS", spark.read.parquet(source))
    shutil.rmtree(tmp_path / "gone")
    assert kept.count() == cache["2023_ORDERS"].count() == 1500
    assert spark.table("`2023_ORDERS`").count() == 1500
    cache.put("2023_ORDERS", kept.limit(2))
    assert cache["2023_ORDERS"].count() == 2 and kept.count() == 1500
    assert list(cache) == ["2023_ORDERS"] and "x" not in cache
    with pytest.raises(tm.UnknownStream, match="'x' is not cached; have .'2023_ORDERS'"):
        cache["x"]
    again = tm.StreamCache(spark, cache.root)
    assert "2023_ORDERS" in again and again.view("2023_ORDERS").count() == 2
    assert spark.table("`2023_ORDERS`").count() == 2


def test_scratch_needs_a_shared_folder(spark):
    def session(master):
        get = lambda key, default=None: master if key == "spark.master" else default
        return SimpleNamespace(conf=SimpleNamespace(get=get))

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(session("yarn"))
    assert shared_dir(session("local[2]")) == shared_dir(session("local"))
    shared = spark.conf.get("spark.checkpoint.dir")
    assert tm.scratch_dir(spark, "x").startswith(shared)
    assert tm.scratch_dir(spark, "x") != tm.scratch_dir(spark, "x")


# --- previews and profiles -------------------------------------------------------


def test_profiles(spark):
    df = spark.createDataFrame(
        [(1, 1.0, None), (2, float("nan"), "x"), (3, 1.0, "y"), (4, None, None)],
        "`a.b` int, x double, s string",
    )
    info = [tuple(r) for r in tm.profile_info(df).orderBy("ordinal").collect()]
    assert info == [
        (1, "a.b", "int", 4, 4),
        (2, "x", "double", 4, 3),
        (3, "s", "string", 4, 2),
    ]
    assert tm.cursor_profile(df, "x").first() == (4, 2, 1, 1, 1.0, 1.0)
    assert [r["a.b"] for r in tm.preview_head(df, "a.b", 2).collect()] == [1, 2]
    assert tm.stream_shape(df, "t").first() == ("t", 4, 3)
    assert [tuple(r) for r in tm.column_list(df).collect()] == [(1, "a.b"), (2, "x"), (3, "s")]
    shapes = tm.stream_shapes({"t": df, "none": df.limit(0).select("x")})
    assert {tuple(r) for r in shapes.collect()} == {("t", 3, 4), ("none", 1, 0)}
    empty = tm.profile_info(df.limit(0)).collect()
    assert [r.n_rows for r in empty] == [0, 0, 0]


def test_profile_plans(orders):
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    assert "TakeOrderedAndProject" in plan(tm.preview_head(orders, "o_orderkey"))
    assert "ReadSchema: struct<>" in plan(tm.stream_shape(orders, "orders"))
    assert plan(tm.profile_info(orders)).count("FileScan") == 1
    assert "ReadSchema: struct<o_totalprice:double>" in plan(
        tm.cursor_profile(orders, "o_totalprice")
    )


# --- which raw files have landed ------------------------------------------------------


def _log_of(spark, out, name):
    return tm.read_log(spark, out, name).filter("mode != 'failed'").count()


def test_empty_and_replaced_raw_files(spark, tmp_path, orders):
    raw, out = f"file:{tmp_path}/raw", f"file:{tmp_path}/out"

    def put(name, rows):
        pq.write_table(rows.toArrow(), f"{tmp_path}/raw/set/{name}.parquet")

    def run():
        tm.land_raw(spark, raw, out, mode="incremental")
        return tm.current(spark, out, "set").drop("source_file")

    def equal(rows, wanted):
        found = tm.reconcile(rows, wanted).first()
        return (found.missing, found.extra) == (0, 0)

    (tmp_path / "raw/set").mkdir(parents=True)
    first, second = orders.filter("o_orderkey % 2 = 0"), orders.filter("o_orderkey % 2 = 1")
    put("a", first)
    put("none", orders.limit(0))
    for _ in range(4):
        assert equal(run(), first)
    assert _log_of(spark, out, "set") == 1
    put("nothing", orders.limit(0))  # alone, it is no reason for a commit
    for _ in range(2):
        assert equal(run(), first)
    assert _log_of(spark, out, "set") == 1
    put("b", second)
    for _ in range(2):
        assert equal(run(), orders)
    assert _log_of(spark, out, "set") == 2
    noted = ledger.taken(spark, out, "set").collect()
    assert {r.object_name: r.n_rows for r in noted} == {
        "set/a.parquet": first.count(),
        "set/b.parquet": second.count(),
        "set/none.parquet": 0,
        "set/nothing.parquet": 0,
    }
    size = {r.object_name: r.length for r in noted}["set/a.parquet"]
    assert size == (tmp_path / "raw/set/a.parquet").stat().st_size
    tm.compact(spark, out, "set")
    assert equal(run(), orders) and _log_of(spark, out, "set") == 3
    put("b", second.limit(3))
    with pytest.warns(UserWarning, match="set/b.parquet"):
        assert equal(run(), first.unionAll(second.limit(3)))
    assert equal(run(), first.unionAll(second.limit(3)))
    assert _log_of(spark, out, "set") == 4
    # the same bytes at another time are a replacement too
    os.utime(tmp_path / "raw/set/a.parquet", (1, 1))
    with pytest.warns(UserWarning, match="set/a.parquet"):
        run()


def test_raw_streams_without_a_ledger(spark, tmp_path, orders):
    """As earlier versions landed them."""
    raw, out = f"file:{tmp_path}/raw", f"file:{tmp_path}/out"
    orders.coalesce(1).write.parquet(f"{raw}/set")
    landed = tm.read_lake(spark, f"{raw}/set").withColumn(
        "source_file", F.concat(F.lit("set/"), F.col("_metadata.file_name"))
    )
    tm.land(landed, out, "set")
    assert ledger.taken(spark, out, "set") is None
    tm.land_raw(spark, raw, out, mode="incremental")
    assert _log_of(spark, out, "set") == 1
    orders.limit(2).coalesce(1).write.mode("append").parquet(f"{raw}/set")
    tm.land_raw(spark, raw, out, mode="incremental")
    assert tm.current(spark, out, "set").count() == orders.count() + 2


def test_a_run_that_died_before_its_log_row_counts_for_nothing(spark, tmp_path, orders, monkeypatch):
    raw, out = f"file:{tmp_path}/raw", f"file:{tmp_path}/out"
    orders.limit(4).coalesce(1).write.parquet(f"{raw}/set")
    tm.land_raw(spark, raw, out, mode="incremental")
    orders.limit(2).coalesce(1).write.mode("append").parquet(f"{raw}/set")
    with monkeypatch.context() as patch:
        append = synclog.append

        def dies(session, root, commit):
            if commit.mode != "failed":
                raise RuntimeError("lost")
            append(session, root, commit)

        patch.setattr(synclog, "append", dies)
        with pytest.raises(tm.SyncFailed, match="lost"):
            tm.land_raw(spark, raw, out, mode="incremental")
    assert tm.current(spark, out, "set").count() == 4
    tm.land_raw(spark, raw, out, mode="incremental")
    assert tm.current(spark, out, "set").count() == 6


# --- catalogs from footers -------------------------------------------------------------


def _described(spark, src, monkeypatch):
    """By tasks, and as Spark's reader says."""
    own = sorted(map(tuple, tm.discover(spark, src).collect()))
    with monkeypatch.context() as patch:
        patch.setattr(catalog, "opener", lambda *_: None)
        other = sorted(map(tuple, tm.discover(spark, src).collect()))
    assert own == other
    return own


def test_footers_tell_what_spark_reads(spark, tmp_path, monkeypatch):
    (tmp_path / "lake/s/many").mkdir(parents=True)
    stamp = pa.timestamp
    table = pa.table(
        {
            "i8": pa.array([1], pa.int8()),
            "u16": pa.array([1], pa.uint16()),
            "u32": pa.array([1], pa.uint32()),
            "u64": pa.array([1], pa.uint64()),
            "f": pa.array([1.0], pa.float32()),
            "dec": pa.array([Decimal("1.20")], pa.decimal128(9, 2)),
            "day": pa.array([date(2020, 1, 1)]),
            "ms": pa.array([datetime(2020, 1, 1)], stamp("ms")),
            "us utc": pa.array([datetime(2020, 1, 1)], stamp("us", "UTC")),
            "b": pa.array([b"x"]),
            "list": pa.array([[1.5]], pa.list_(pa.float32())),
            "deep": pa.array([{"a": 1, "b": ["x"]}]),
            "ok": pa.array([True]),
        }
    )
    pq.write_table(table, tmp_path / "lake/s/arrow.parquet")
    pq.write_table(table, tmp_path / "lake/s/old.parquet", use_deprecated_int96_timestamps=True)
    for k, more in enumerate(({"b": ["x"], "a": [1]}, {"z": [1.5], "b": ["y"]}, {"a": [2]})):
        pq.write_table(pa.table(more), tmp_path / f"lake/s/many/{k}.parquet")
    rows = spark.sql("SELECT 1 AS id, cast('a' AS varchar(3)) v, map('k', array(1L)) m")
    rows.write.parquet(f"file:{tmp_path}/lake/s/spark")
    rows.withColumn("dt", F.lit(7)).write.partitionBy("dt").parquet(f"file:{tmp_path}/lake/t/parted")
    (tmp_path / "lake/s/spark/_marker").write_bytes(b"no Parquet")
    src = tm.LakeSource(f"file:{tmp_path}/lake", suffix="")
    found = _described(spark, src, monkeypatch)
    assert [r[2:] for r in found if r[1] == "many"] == [
        (1, "b", "string"), (2, "a", "bigint"), (3, "z", "double"),
    ]
    assert ("t", "parted", 4, "dt", "int") in found
    assert _described(spark, LAKE, monkeypatch)


def test_footers_that_disagree(spark, tmp_path):
    folder = tmp_path / "lake/s/t"
    folder.mkdir(parents=True)
    pq.write_table(pa.table({"id": [1], "x": ["a"]}), folder / "a.parquet")
    pq.write_table(pa.table({"id": ["1"], "x": ["a"]}), folder / "b.parquet")
    src = tm.LakeSource(f"file:{tmp_path}/lake", ("s",), suffix="")
    with pytest.raises(tm.SchemaDrift, match="id: "):
        tm.discover(spark, src)
    (folder / "b.parquet").write_bytes(b"broken")
    with pytest.raises(Exception, match="b.parquet"):
        tm.discover(spark, src)


def test_a_catalog_reads_no_stream_on_the_driver(spark, monkeypatch):
    def refuse(*_):
        raise AssertionError("read by Spark's reader")

    monkeypatch.setattr(catalog, "read_lake", refuse)
    assert tm.discover(spark, LAKE).select("stream").distinct().count() == 14


# --- marks from footers -----------------------------------------------------------------


def test_marks_from_footers(spark, tmp_path):
    folder = tmp_path / "lake/s/t x"
    folder.mkdir(parents=True)
    at = datetime(2024, 2, 29, 1, 2, 3, 456789)
    columns = {
        "i": (pa.int32(), [3, -1, None]),
        "l": (pa.int64(), [None, 1 << 60, 5]),
        "day": (pa.date32(), [date(1960, 1, 1), date(2020, 5, 5), None]),
        "ntz": (pa.timestamp("us"), [at, None, datetime(1969, 12, 31, 23, 0, 0, 1)]),
        "ms": (pa.timestamp("ms"), [datetime(2020, 1, 1, 0, 0, 0, 7000), None, None]),
        "utc": (pa.timestamp("us", "UTC"), [at, None, None]),
        "none": (pa.int64(), [None, None, None]),
        "f": (pa.float64(), [1.5, float("nan"), None]),
        "s": (pa.string(), ["b", "a", None]),
    }
    table = pa.table({n: pa.array(v, k) for n, (k, v) in columns.items()})
    pq.write_table(table.slice(0, 2), folder / "a é.parquet", row_group_size=1)
    pq.write_table(table.slice(2, 1), folder / "b.parquet")
    pq.write_table(table.slice(0, 0), folder / "empty.parquet")
    pq.write_table(table.select(["s"]), folder / "lacks.parquet")
    src = tm.LakeSource(f"file:{tmp_path}/lake", ("s",), suffix="")
    df = tm.read_stream(spark, src, "t x")
    for name in columns:
        want = tm.high_water_mark(df, name)
        got = tm.stream_mark(spark, src, "t x", name)
        assert got.dtypes == want.dtypes
        assert str(got.collect()) == str(want.collect())  # NaN is not equal to itself
        tells = streams._from_footers(spark, df, name, df.schema[name].dataType)
        assert (tells is None) == (name in ("f", "s"))
        if tells is not None:
            plan = got._jdf.queryExecution().executedPlan().toString()
            assert "parquet" not in plan.lower()
            assert tells[1] == 6
            told = tm.source_mark(spark, src, "t x", name)
            with pytest.MonkeyPatch.context() as patch:
                patch.setattr(streams, "_from_footers", lambda *_: None)
                scanned = tm.source_mark(spark, src, "t x", name)
            dtype = df.schema[name].dataType
            if told is None:
                assert scanned is None
            else:
                same = spark.range(1).select(from_text(told, dtype) == from_text(scanned, dtype))
                assert same.first()[0]
                assert tm.source_mark(spark, src, "t x", name, above=told) is None
    pq.write_table(table, folder / "mute.parquet", write_statistics=False)
    df = tm.read_stream(spark, src, "t x")
    assert streams._from_footers(spark, df, "i", df.schema["i"].dataType) is None
    assert tm.stream_mark(spark, src, "t x", "i").first().n_rows == 9


def test_a_mark_is_that_of_the_files_read(spark, tmp_path, orders):
    """A file that comes between the read and the mark does not move it."""
    src = tm.LakeSource(f"file:{tmp_path}", ("s",), suffix="")
    orders.filter("o_orderkey < 100").write.parquet(src.path("s", "t"))
    df = tm.read_stream(spark, src, "t")
    orders.write.mode("append").parquet(src.path("s", "t"))
    assert int(tm.source_mark(spark, src, "t", "o_orderkey", df=df)) < 100


def test_a_mark_of_partition_values(spark, tmp_path):
    src = tm.LakeSource(f"file:{tmp_path}", ("s",), suffix="")
    rows = spark.range(9).selectExpr("id", "id % 3 AS k")
    rows.write.partitionBy("k").parquet(src.path("s", "t"))
    assert tm.stream_mark(spark, src, "t", "k").first() == (2, 9)
