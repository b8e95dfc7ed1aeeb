"""CSV bytes, file pickup and the whole workflows."""

import glob
import os
import shutil
import time
from collections import Counter

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

import tidemark as tm
from tidemark.plans import extract, land_folders, migrate, read_back
from tidemark.streaming import pickup

HARD = pd.DataFrame(
    {
        "a": [None, "", " x ", 'q"q', "l\nl", "é,#", "\\b", '"', "r\rr", " ", "\r\n", "'"],
        "b": ["1", None, "", "#c", "'", "\t", "x\\", "a;b", "t ", None, '\\"', "\ufeff"],
    }
)


def csv_bytes(tmp_path, name="csv"):
    (part,) = glob.glob(f"{tmp_path}/{name}/part-*")
    with open(part, "rb") as file:
        return file.read()


def hard(spark):
    rows = HARD.astype(object).where(HARD.notna(), None)
    return spark.createDataFrame(rows, "a string, b string").coalesce(1)


@pytest.mark.parametrize("columns", [["a", "b"], ["a"], ["b", "a"]])
@pytest.mark.parametrize("bom", [True, False])
def test_csv_bytes_equal_pandas(spark, tmp_path, columns, bom):
    tm.write_csv(hard(spark).select(columns), f"file:{tmp_path}/csv", bom=bom)
    want = HARD[columns].to_csv(index=False).encode("utf-8-sig" if bom else "utf-8")
    assert csv_bytes(tmp_path) == want


@pytest.mark.parametrize("columns", [["a", "b"], ["a"]])
def test_csv_comes_back(spark, tmp_path, columns):
    df = hard(spark).select(columns)
    tm.write_csv(df, f"file:{tmp_path}/csv")
    back = tm.read_csv(spark, f"file:{tmp_path}/csv", df.schema)
    want = df.select(*(F.nullif(c, F.lit("")).alias(c) for c in columns))
    (row,) = tm.reconcile(want, back).collect()
    assert (row.n_source, row.n_target, row.missing, row.extra) == (12, 12, 0, 0)


AWKWARD = ["a", '"', ",", "\n", "\r", "\\", " ", "\t", "#", "'", "é", "\ufeff", "\x00"]
AWKWARD += ["\x01", "|", ";", "\u2028", "\x0b", "\x0c", "😀", "\x85", "\xa0", "="]
TEXTS = st.none() | st.text(st.sampled_from(AWKWARD), max_size=6)


@settings(max_examples=6, deadline=None)
@given(
    rows=st.integers(1, 3).flatmap(
        lambda width: st.lists(st.tuples(*[TEXTS] * width), min_size=60, max_size=120)
    )
)
def test_any_text_in_csv(spark, tmp_path_factory, rows):
    """The bytes of pandas, and back without loss."""
    folder = tmp_path_factory.mktemp("any")
    columns = [f"c{i}" for i in range(len(rows[0]))]
    schema = ", ".join(f"{c} string" for c in columns)
    df = spark.createDataFrame(rows, schema).coalesce(1)
    tm.write_csv(df, f"file:{folder}/csv")
    want = pd.DataFrame(rows, columns=columns).to_csv(index=False)
    assert csv_bytes(folder) == want.encode("utf-8-sig")
    back = tm.read_csv(spark, f"file:{folder}/csv", schema).collect()
    assert Counter(map(tuple, back)) == Counter(tuple(v or None for v in r) for r in rows)


def test_csv_of_every_type(spark, tmp_path):
    df = spark.sql(
        "SELECT 1 AS i, 1.5D AS d, cast(2.50 AS decimal(9,2)) AS m, true AS t,"
        " date'2020-01-02' AS day, timestamp_ntz'2020-01-02 03:04:05.678901' AS at,"
        " timestamp'2020-01-02 03:04:05' AS ts, array(1, 2) AS v, map('k', 1) AS p,"
        " struct(timestamp_ntz'2020-01-02 03:04:05.678901' AS x, cast(NULL AS int) AS y) AS q,"
        " X'00FF6162' AS b, array(X'00', NULL) AS n"
    )
    tm.write_csv(df, f"file:{tmp_path}/csv")
    line = csv_bytes(tmp_path).decode("utf-8-sig").splitlines()[1]
    assert line == (
        "1,1.5,2.50,true,2020-01-02,2020-01-02 03:04:05.678901,"
        '2020-01-02 03:04:05.000000+00:00,"[1,2]","{""k"":1}",'
        '"{""x"":""2020-01-02 03:04:05.678901"",""y"":null}",AP9hYg==,"[""AA=="",null]"'
    )
    back = tm.read_csv(spark, f"file:{tmp_path}/csv", df.schema)
    assert back.dtypes == df.dtypes and back.collect() == df.collect()
    odd = spark.sql("SELECT map(1, 'x') AS m, 1 AS i")
    tm.write_csv(odd, f"file:{tmp_path}/odd")
    with pytest.raises(ValueError, match="'m'.*text keys"):
        tm.read_csv(spark, f"file:{tmp_path}/odd", odd.schema)
    plain = df
    tm.write_csv(plain, f"file:{tmp_path}/plain")
    want = plain.selectExpr("*", "unix_micros(ts) AS us").collect()
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        back = tm.read_csv(spark, f"file:{tmp_path}/plain", plain.schema)
        assert back.selectExpr("*", "unix_micros(ts) AS us").collect() == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_empty_csv_still_has_its_header(spark, tmp_path):
    tm.write_csv(hard(spark).limit(0), f"file:{tmp_path}/csv")
    assert csv_bytes(tmp_path) == b"\xef\xbb\xbfa,b\n"


def test_every_csv_part_has_a_header_and_one_file_on_request(spark, tmp_path, orders):
    tm.write_csv(orders.repartition(3), f"file:{tmp_path}/many")
    parts = glob.glob(f"{tmp_path}/many/part-*")
    assert len(parts) == 3
    for part in parts:
        with open(part, "rb") as file:
            assert file.read().startswith(b"\xef\xbb\xbfo_orderkey,")
    tm.write_csv(orders.coalesce(1), f"file:{tmp_path}/cut", max_records_per_file=400)
    cut = glob.glob(f"{tmp_path}/cut/part-*")
    assert len(cut) == 4 and all(open(p, "rb").read(3) == b"\xef\xbb\xbf" for p in cut)
    tm.write_csv(orders.repartition(3), f"file:{tmp_path}/one", single_file=True)
    assert csv_bytes(tmp_path, "one").count(b"\n") == 1501


# --- pickup ------------------------------------------------------------------


def test_files_are_picked_up_once(spark, tmp_path, orders):
    box = tmp_path / "in box"
    box.mkdir()

    def drop(name, rows, age_days=0):
        rows.coalesce(1).write.parquet(f"file:{tmp_path}/made-{name}")
        (part,) = glob.glob(f"{tmp_path}/made-{name}/part-*")
        shutil.copy(part, box / f"{name}.parquet")
        then = time.time() - age_days * 86400
        os.utime(box / f"{name}.parquet", (then, then))

    def run():
        picked = tm.pickup_new_files(
            spark,
            f"file:{box}",
            f"file:{tmp_path}/rows",
            f"file:{tmp_path}/checkpoint",
            orders.schema,
            files_per_batch=1,
        )
        rows = picked.groupBy("source_file").count().collect()
        return {os.path.basename(r.source_file): r["count"] for r in rows}

    assert run() == {}
    drop("a+b %é", orders.limit(25))
    drop("b", orders.limit(5))
    assert run() == {"a+b %é.parquet": 25, "b.parquet": 5}
    assert run() == {"a+b %é.parquet": 25, "b.parquet": 5}
    # A file much older than those seen is new all the same.
    drop("old", orders.limit(7), age_days=400)
    assert run() == {"a+b %é.parquet": 25, "b.parquet": 5, "old.parquet": 7}


def test_a_file_that_does_not_fit_is_named(spark, tmp_path):
    spark.sql("SELECT 'x' AS id").coalesce(1).write.parquet(f"file:{tmp_path}/box")
    schema = spark.range(1).schema
    places = [f"file:{tmp_path}/{name}" for name in ("box", "rows", "checkpoint")]
    assert tm.pickup_new_files(spark, *places, schema).count() == 0
    (row,) = tm.refused_files(spark, places[1]).collect()
    assert row.reason == "id: string against bigint" and "part-" in row.source_file


# --- workflows ---------------------------------------------------------------


SRC = tm.LakeSource("/root/testdata", ("sf0.001",))


def test_migrate(spark, root):
    log = migrate(spark, SRC, root, ["orders", "nation"], {"orders": "o_orderdate"})
    assert {(r.stream, r["mode"], r.n_rows) for r in log.collect()} == {
        ("orders", "full", 1500),
        ("nation", "full", 25),
    }
    log = migrate(spark, SRC, root, ["orders"], {"orders": "o_orderdate"})
    assert [(r["mode"], r.n_rows) for r in log.collect()] == [("incremental", 0)]
    log = migrate(
        spark, SRC, root, ["orders"], {"orders": "o_orderdate"}, full_refresh=True
    )
    assert [(r["mode"], r.n_rows) for r in log.collect()] == [("full", 1500)]
    with pytest.raises(tm.UnknownStream, match="Orders"):
        migrate(spark, SRC, root, ["Orders"])
    with pytest.raises(ValueError, match="not selected"):
        migrate(spark, SRC, root, ["nation"], {"orders": "o_orderdate"})
    with pytest.raises(tm.CursorRefused, match="'orders' has no column 'O_ORDERDATE'"):
        migrate(spark, SRC, root, ["orders"], {"orders": "O_ORDERDATE"})


def test_migrate_from_two_schemas(spark, root):
    both = tm.LakeSource("/root/testdata", ("sf0.001", "sf0.01"))
    log = migrate(spark, both, root, ["labels"], {"labels": "doc_id"})
    assert {(r.stream, r.n_rows) for r in log.collect()} == {
        ("sf0.001.labels", 87),
        ("sf0.01.labels", 399),
    }
    catalog = tm.discover(spark, both)
    (row,) = tm.configured_catalog(
        catalog, [tm.StreamPlan("labels", schema="sf0.01")]
    ).collect()
    assert (row.schema_name, row["mode"], row.n_columns) == ("sf0.01", "full", 3)
    with pytest.raises(tm.UnknownStream, match="labels"):
        tm.configured_catalog(catalog, [tm.StreamPlan("labels", schema="sf0.1")])


def test_extract_from_two_schemas(spark, root, tmp_path):
    both = tm.LakeSource("/root/testdata", ("sf0.001", "sf0.01"))
    tables = extract(spark, both, root, f"file:{tmp_path}/csv", ["labels"])
    assert {name: df.count() for name, df in tables.items()} == {
        "sf0.001.labels": 87,
        "sf0.01.labels": 399,
    }


def test_extract_keys_results_by_name(spark, root, tmp_path):
    streams = ["orders", "documents"]
    tables = extract(spark, SRC, root, f"file:{tmp_path}/csv", streams)
    for name in streams:
        source = spark.read.parquet(f"{SMALL}/{name}.parquet")
        back = tm.read_csv(spark, f"file:{tmp_path}/csv/{name}", source.schema)
        for copy in (tables[name], back):
            (row,) = tm.reconcile(source, copy).collect()
            assert (row.missing, row.extra) == (0, 0)


def test_read_back(spark, tmp_path, orders):
    box = tmp_path / "box"
    box.mkdir()
    orders.coalesce(1).write.parquet(f"file:{tmp_path}/made")
    (part,) = glob.glob(f"{tmp_path}/made/part-*")
    name = "2025_12_01_1764579501178_0.parquet"
    shutil.copy(part, box / name)
    for key in ("", name):
        got = read_back(spark, f"file:{box}", "o_orderkey", key)
        assert got["head"].count() == 5
        assert got["shape"].first()[1:] == (1500, 6)
        assert [r.column_name for r in got["columns"].collect()] == orders.columns
        assert got["info"].count() == 6


def test_land_folders(spark, tmp_path, orders):
    for name in ("jan", "feb"):
        orders.limit(9).write.parquet(f"file:{tmp_path}/raw/{name}")
    log = land_folders(spark, f"file:{tmp_path}/raw", f"file:{tmp_path}/lake", "raw/orders")
    assert {r.stream: r.n_rows for r in log.collect()} == {"jan": 9, "feb": 9}
    assert tm.current(spark, f"file:{tmp_path}/lake/raw/orders", "feb").count() == 9


def _inbox(tmp_path):
    places = [f"file:{tmp_path}/{n}" for n in ("in box", "rows", "checkpoint")]
    (tmp_path / "in box").mkdir()

    def put(name, columns):
        path = tmp_path / "in box" / name
        path.parent.mkdir(exist_ok=True)
        if isinstance(columns, bytes):
            path.write_bytes(columns)
        else:
            pq.write_table(pa.table(columns), path)

    return places, put


def test_unfit_files_are_set_aside(spark, tmp_path):
    places, put = _inbox(tmp_path)
    schema = T.StructType.fromDDL("id bigint, s string")
    put("good.parquet", {"id": [1], "s": ["a"]})
    put("more [x].parquet", {"id": [2], "s": ["b"], "extra": [True]})
    put("deep/other.parquet", {"id": ["3"], "s": [4.5]})
    put("broken.parquet", b"no Parquet file")
    put("lacks.parquet", {"s": ["c"]})
    put("narrow é.parquet", {"id": pa.array([5], pa.int32())})
    for _ in range(2):
        picked = tm.pickup_new_files(spark, *places, schema)
        rows = sorted(picked.drop("source_file").collect(), key=str)
        assert rows == sorted([(1, "a"), (None, "c"), (5, None)], key=str)
        names = {r.source_file.rpartition("/")[2] for r in picked.collect()}
        assert names == {"good.parquet", "lacks.parquet", "narrow é.parquet"}
        refused = tm.refused_files(spark, places[1]).collect()
        why = {r.source_file.rpartition("/")[2]: r.reason for r in refused}
        assert why.pop("broken.parquet").startswith("Parquet")
        assert why == {
            "more [x].parquet": "extra: not wanted",
            "other.parquet": "id: string against bigint; s: double against string",
        }
    put("late.parquet", {"id": [9], "s": ["z"]})
    assert tm.pickup_new_files(spark, *places, schema).count() == 4
    assert tm.refused_files(spark, places[1]).count() == 3


def test_further_columns_are_kept_on_request(spark, tmp_path):
    places, put = _inbox(tmp_path)
    schema = T.StructType.fromDDL("id bigint")
    put("a.parquet", {"id": [1]})
    put("b.parquet", {"id": [2], "extra": ["x"]})
    picked = tm.pickup_new_files(spark, *places, schema, extra="keep")
    assert {tuple(r)[:2] for r in picked.collect()} == {(1, None), (2, "x")}
    put("c.parquet", {"id": [3], "extra": [7]})
    put("d.parquet", {"id": [4], "extra": ["y"], "new": [1.5]})
    picked = tm.pickup_new_files(spark, *places, schema, extra="keep")
    assert picked.columns == ["id", "extra", "new", "source_file"]
    assert {tuple(r)[:3] for r in picked.collect()} == {
        (1, None, None), (2, "x", None), (4, "y", 1.5),
    }
    (row,) = tm.refused_files(spark, places[1]).collect()
    assert row.reason == "extra: bigint against string"
    with pytest.raises(ValueError, match="refuse"):
        tm.pickup_new_files(spark, *places, schema, extra="drop")


def test_a_batch_run_again_replaces_what_it_wrote(spark, tmp_path):
    places, put = _inbox(tmp_path)
    schema = T.StructType.fromDDL("id bigint")
    put("a.parquet", {"id": [1, 2]})
    take = pickup._taker(places[0], places[1], schema, False)
    batch = spark.createDataFrame([(f"{places[0]}/a.parquet",)], "path string")
    for _ in range(2):
        take(batch, 0)
    rows = spark.read.option("recursiveFileLookup", True).parquet(places[1])
    assert sorted(r.id for r in rows.collect()) == [1, 2]


def test_an_empty_inbox(spark, tmp_path):
    places, put = _inbox(tmp_path)
    schema = T.StructType.fromDDL("id bigint")
    assert tm.pickup_new_files(spark, *places, schema).collect() == []
    assert tm.refused_files(spark, places[1]).collect() == []
    put("broken.parquet", b"x")
    assert tm.pickup_new_files(spark, *places, schema).columns == ["id", "source_file"]
    assert tm.refused_files(spark, places[1]).count() == 1
