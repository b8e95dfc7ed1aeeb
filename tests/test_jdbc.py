"""JDBC reads without a database.

The options and SQL handed to Spark are checked as text; the SQL and the split
predicates are then run, on Spark tables that stand in for the database's.
"""

import re
from datetime import date, datetime
from decimal import Decimal
from functools import reduce

import duckdb
import pytest
from conftest import SMALL
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import tidemark as tm
from tidemark.plans import migrate
from tidemark.sources import jdbc

SRC = tm.JdbcSource.oracle(
    "db.example", "1521", "SVC", "reader", "s3cret", schemas=("SALES",)
)


class Recorder:
    """Stands in for a session and keeps what the reader was given."""

    def __init__(self):
        self.given, self.read = {}, self

    def format(self, name):
        self.given["format"] = name
        return self

    def options(self, **options):
        self.given |= options
        return self

    def option(self, key, value):
        self.given[key] = value
        return self

    def load(self):
        return self.given

    def jdbc(self, url, table, predicates, properties):
        return {"url": url, "dbtable": table, "predicates": predicates} | properties


def test_one_task_read():
    got = tm.read_stream(Recorder(), SRC, "2023_ORDERS")
    assert got == {
        "format": "jdbc",
        "url": "jdbc:oracle:thin:@//db.example:1521/SVC",
        "user": "reader",
        "password": "s3cret",
        "driver": "oracle.jdbc.OracleDriver",
        "fetchsize": "10000",
        "dbtable": '"SALES"."2023_ORDERS"',
    }


def test_stride_and_split_reads():
    stride = tm.Stride("ID", 0, 1000, 64)
    got = tm.read_stream(Recorder(), SRC, "T", stride)
    assert got["partitionColumn"] == "ID"
    assert (got["lowerBound"], got["upperBound"]) == ("0", "1000")
    assert got["numPartitions"] == "64"
    exact = tm.Stride("ID", Decimal("0E-10"), 10.5, 2)
    got = tm.read_stream(Recorder(), SRC, "T", exact)
    assert (got["lowerBound"], got["upperBound"]) == ("0", "10")
    got = tm.read_stream(Recorder(), SRC, 'odd"name', tm.key_split("ID", 3))
    assert len(got["predicates"]) == 3
    assert got["dbtable"] == '"SALES"."odd""name"'
    assert got["password"] == "s3cret"
    assert tm.rowid_split(2).predicates == (
        "ORA_HASH(ROWID, 1) = 0",
        "ORA_HASH(ROWID, 1) = 1",
    )


def test_spark_fails_before_any_row_where_the_driver_is_missing(spark, root):
    for cut in (None, tm.Stride("ID", 0, 9, 2), tm.key_split("ID", 2)):
        with pytest.raises(Exception, match="oracle.jdbc.OracleDriver"):
            tm.read_stream(spark, SRC, "T", cut)
    with pytest.raises(tm.SyncFailed, match="OracleDriver") as failed:
        tm.sync(spark, SRC, root, ["T"])
    assert "s3cret" not in str(failed.value)
    assert tm.read_log(spark, root, "T").first()["mode"] == "failed"


def test_the_schema_must_be_clear():
    both = tm.JdbcSource("jdbc:x:y", schemas=("A", "B"))
    with pytest.raises(ValueError, match="name the schema"):
        tm.read_stream(Recorder(), both, "T")
    assert tm.read_stream(Recorder(), both, "T", schema="B")["dbtable"] == '"B"."T"'


def test_secrets_stay_out_of_sight(monkeypatch):
    url_secrets = tm.JdbcSource("jdbc:oracle:thin:joe/hush@//h:1/s", password="s3cret")
    for text in (repr(url_secrets), repr(SRC), url_secrets.redact("joe/hush@ s3cret")):
        assert "hush" not in text.replace("joe/hush@ ", "") and "s3cret" not in text
    assert "pw" not in repr(tm.JdbcSource("jdbc:postgresql://u:pw@h/db"))
    for name in ("HOST", "PORT", "SERVICE_NAME", "USER", "PASSWORD"):
        monkeypatch.setenv(f"ORACLE_{name}", "1521" if name == "PORT" else "x")
    assert tm.JdbcSource.oracle_from_env(("S",)).url == "jdbc:oracle:thin:@//x:1521/x"
    monkeypatch.delenv("ORACLE_HOST")
    with pytest.raises(KeyError, match="ORACLE_HOST"):
        tm.JdbcSource.oracle_from_env()


def test_store_settings():
    conf = tm.store_conf("store:9000", "key", "secret")
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert not any("commit" in key for key in conf)
    conf = tm.store_conf("s:1", "key", "secret", direct_commit=True)
    assert conf["spark.hadoop.fs.s3a.committer.name"] == "magic"
    conf = tm.store_conf("https://store", "key", "secret", path_style=False)
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "true"
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "false"


# --- split predicates ----------------------------------------------------------


@pytest.fixture
def ansi_names(spark):
    spark.conf.set("spark.sql.ansi.doubleQuotedIdentifiers", "true")
    yield
    spark.conf.unset("spark.sql.ansi.doubleQuotedIdentifiers")


def with_nulls(orders):
    """Keys on both sides of zero, some NULL; a third of the prices equal."""
    key = F.col("o_orderkey")
    return orders.select(
        F.when(key % 7 != 0, key - 700).alias("id"),
        F.when(key % 3 == 0, 1000.0).otherwise(F.col("o_totalprice")).alias("price"),
        F.when(key % 5 != 0, F.col("o_orderdate")).alias("at"),
        F.col("o_orderdate").cast("date").alias("day"),
        F.col("o_totalprice").cast("decimal(18,4)").alias("amount"),
    )


def share_sizes(df, split):
    return [df.filter(p).count() for p in split.predicates]


@pytest.mark.parametrize("key", ["price", "at", "day", "amount", "id"])
def test_range_split_reads_every_row_once(spark, ansi_names, orders, key):
    df = with_nulls(orders)
    cuts = tm.balanced_cuts(df, key, 6)
    sizes = share_sizes(df, tm.range_split(key, cuts))
    assert sum(sizes) == df.count() == 1500
    if key != "price":
        assert max(sizes) < 650  # NULLs ride with the first share
    nulls = df.filter(F.col(key).isNull())
    assert share_sizes(nulls, tm.range_split(key, cuts))[1:] == [0] * len(cuts)


def test_key_split_reads_every_row_once_and_evenly(spark, ansi_names, orders):
    df = with_nulls(orders)
    sizes = share_sizes(df, tm.key_split("id", 5))
    assert sum(sizes) == 1500
    unset = df.filter("id IS NULL").count()
    assert max(sizes[1:]) - min(sizes[1:]) < 30 and sizes[0] - unset < max(sizes) + 30


def test_key_split_covers_decimals(spark, ansi_names):
    df = spark.sql(
        "SELECT cast(id - 50 AS decimal(20,2)) / 4 AS id FROM range(100)"
        " UNION ALL SELECT cast(NULL AS decimal(20,2))"
    )
    assert sum(share_sizes(df, tm.key_split("id", 7))) == 101


def test_predicates_run_on_another_engine():
    db = duckdb.connect()
    db.execute(
        "CREATE VIEW t AS SELECT CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey - 700 END"
        f" AS id, o_orderdate AS at FROM read_parquet('{SMALL}/orders.parquet')"
    )
    for split in (
        tm.key_split("id", 4),
        tm.range_split("id", [-100, 0, 250]),
        tm.range_split("at", [datetime(1996, 1, 1), datetime(1998, 1, 1)]),
        tm.range_split("at", [date(1999, 1, 1)]),
        tm.range_split("at", []),
    ):
        sizes = [
            db.sql(f"SELECT count(*) FROM t WHERE {p}").fetchall()[0][0]
            for p in split.predicates
        ]
        assert sum(sizes) == 1500


def test_a_split_reads_something():
    with pytest.raises(ValueError, match="no row"):
        tm.key_split("id", 0)
    with pytest.raises(ValueError, match="no row"):
        tm.rowid_split(0)
    with pytest.raises(ValueError, match="positive"):
        tm.StreamPlan("t", split_by="id", tasks=0)


def test_cut_points_must_increase():
    with pytest.raises(ValueError, match="increase"):
        tm.range_split("id", [5, 5])
    with pytest.raises(TypeError):
        jdbc.sql_literal(object())
    assert jdbc.sql_literal(Decimal("1.50")) == "1.50"
    assert jdbc.sql_literal("it's") == "'it''s'"
    assert jdbc.sql_literal(datetime(2020, 1, 2, 3)) == "TIMESTAMP '2020-01-02 03:00:00'"


def test_strings_do_not_cut(orders):
    with pytest.raises(TypeError, match="string"):
        tm.balanced_cuts(orders, "o_orderstatus", 4)


# --- the SQL, run on stand-in tables --------------------------------------------


def test_dictionary_sql_equals_lake_discovery(spark):
    db = duckdb.connect()
    for name in ("orders", "nation"):
        db.execute(f"CREATE VIEW {name} AS FROM read_parquet('{SMALL}/{name}.parquet')")
    sql = jdbc.dictionary_query("ansi", ["main"])
    got = db.sql(f"SELECT stream, ordinal, column_name FROM {sql}").fetchall()
    lake = tm.LakeSource("/root/testdata", ("sf0.001",))
    want = tm.select(tm.discover(spark, lake), ["orders", "nation"])
    rows = want.select("stream", "ordinal", "column_name").collect()
    assert sorted(got) == sorted(map(tuple, rows))


def test_dictionary_sql_quotes_owners():
    sql = jdbc.dictionary_query("oracle", ["SALES", "O'NEIL"])
    assert "FROM ALL_TAB_COLUMNS WHERE OWNER IN ('SALES', 'O''NEIL')" in sql
    assert "WHERE" not in jdbc.dictionary_query("oracle", [])


@pytest.fixture
def stand_in(spark, ansi_names, monkeypatch, tmp_path, orders):
    """Answers JDBC reads from Spark tables of the same names."""
    spark.sql("CREATE DATABASE IF NOT EXISTS sales")
    spark.sql('DROP TABLE IF EXISTS sales."2023_ORDERS"')
    orders.filter("o_orderdate <= '1998-01-01'").write.parquet(f"{tmp_path}/db")
    spark.sql(
        f"CREATE TABLE sales.\"2023_ORDERS\" USING parquet LOCATION '{tmp_path}/db'"
    )
    asked = []

    def read_table(spark, src, dbtable, partition=None):
        asked.append((dbtable, partition))
        if "ALL_TAB_COLUMNS" in dbtable:
            names = spark.table('sales."2023_ORDERS"').columns
            return spark.createDataFrame(
                [("SALES", "2023_ORDERS", Decimal(i), n, "X") for i, n in enumerate(names, 1)],
                "schema_name string, stream string, ordinal decimal(38,10),"
                " column_name string, dtype string",
            )
        whole = f"SELECT * FROM {dbtable}"
        if isinstance(partition, tm.Split):
            parts = [spark.sql(f"{whole} WHERE {p}") for p in partition.predicates]
            return reduce(DataFrame.unionAll, parts)
        return spark.sql(whole)

    monkeypatch.setattr(jdbc, "read_table", read_table)
    monkeypatch.setattr("tidemark.sources.catalog.read_table", read_table)

    def arrive(rows, fresh=False):
        if fresh:
            rows.write.parquet(f"{tmp_path}/fresh")
            spark.sql(
                'CREATE TABLE sales."2023_ORDERS" USING parquet'
                f" LOCATION '{tmp_path}/fresh'"
            )
            return
        rows.write.mode("append").parquet(f"{tmp_path}/db")
        spark.catalog.refreshTable('sales."2023_ORDERS"')

    yield arrive, asked
    spark.sql('DROP TABLE sales."2023_ORDERS"')


def test_whole_flow_on_a_stand_in_database(spark, stand_in, root, orders):
    arrive, asked = stand_in
    catalog = tm.discover(spark, SRC)
    assert [r.stream for r in tm.select(catalog, ["2023_ORDERS"]).collect()] == [
        "2023_ORDERS"
    ] * 6
    plan = tm.StreamPlan(
        "2023_ORDERS",
        "incremental",
        "o_orderdate",
        partition=tm.key_split("o_orderkey", 4),
        inclusive=True,
    )
    tm.sync(spark, SRC, root, [plan])
    arrive(orders.filter("o_orderdate > '1998-01-01'"))
    (row,) = tm.sync(spark, SRC, root, [plan]).collect()
    assert (row["mode"], row.hwm) == (
        "incremental",
        str(orders.agg(F.max("o_orderdate")).first()[0]),
    )
    (same,) = tm.reconcile(orders, tm.current(spark, root, "2023_ORDERS")).collect()
    assert (same.n_target, same.missing, same.extra) == (1500, 0, 0)
    # Rows that vanish from the top do not move the mark back.
    spark.sql('DROP TABLE sales."2023_ORDERS"')
    arrive(orders.limit(0), fresh=True)
    (after,) = tm.sync(spark, SRC, root, [plan]).collect()
    assert (after.n_rows, after.hwm) == (0, row.hwm)
    marks = [table for table, _ in asked if "MAX(" in table]
    assert marks[0] == '(SELECT MAX("o_orderdate") AS "mark" FROM "SALES"."2023_ORDERS") q'


def test_stride_bounds_come_from_the_database(spark, stand_in):
    stride = jdbc.stride_for(spark, SRC, "SALES", "2023_ORDERS", "o_orderkey", 8)
    assert (stride.column, stride.lower, stride.partitions) == ("o_orderkey", "0", 8)
    stride = jdbc.stride_for(spark, SRC, "SALES", "2023_ORDERS", "o_totalprice", 8)
    assert stride.lower.isdigit() and stride.upper.isdigit()
    stride = jdbc.stride_for(spark, SRC, "SALES", "2023_ORDERS", "o_orderdate", 8)
    assert (stride.lower[:4], len(stride.upper)) == ("1995", 19)


def test_reads_are_cut_by_what_is_known(spark, stand_in, root, orders):
    """Equal widths at first, remainders for an increment, equal counts after."""
    arrive, asked = stand_in

    def run(mode):
        asked.clear()
        plan = tm.StreamPlan(
            "2023_ORDERS", mode, "o_orderdate", split_by="o_orderkey", tasks=4
        )
        tm.sync(spark, SRC, root, [plan])
        (cut,) = [p for table, p in asked if table == '"SALES"."2023_ORDERS"']
        return cut

    assert run("incremental") == tm.Stride("o_orderkey", "0", "1499", 4)
    arrive(orders.filter("o_orderdate > '1998-01-01'"))
    assert run("incremental") == tm.key_split("o_orderkey", 4)
    assert len(run("full").predicates) == 4
    (same,) = tm.reconcile(orders, tm.current(spark, root, "2023_ORDERS")).collect()
    assert (same.n_target, same.missing, same.extra) == (1500, 0, 0)


def test_migrate_shares_out_its_reads(spark, stand_in, root):
    arrive, asked = stand_in
    migrate(spark, SRC, root, ["2023_ORDERS"], split_by={"2023_ORDERS": "o_orderkey"}, tasks=5)
    assert [p for _, p in asked if p] == [tm.Stride("o_orderkey", "0", "1499", 5)]
    with pytest.raises(ValueError, match="not selected: ..nope"):
        migrate(spark, SRC, root, ["2023_ORDERS"], split_by={"nope": "x"})


def test_unknown_owner_fails_by_name(spark, stand_in):
    with pytest.raises(tm.UnknownStream, match="'sales'"):
        tm.discover(spark, SRC, schemas=["SALES", "sales"])


# --- reads as of one moment ------------------------------------------------------


def test_all_parts_of_a_read_see_one_moment(spark, monkeypatch, root, orders):
    """A table that grows between any two reads, of which the database knows all states."""
    states = {100 + k: orders.filter(f"o_orderkey <= {1000 + 500 * k}") for k in range(40)}
    clock = iter(sorted(states))
    asked = []

    def read_table(spark, src, dbtable, partition=None):
        asked.append(dbtable)
        now = next(clock)
        if dbtable == jdbc.MOMENT:
            return spark.createDataFrame([(Decimal(now),)], "moment decimal(38,0)")
        found = re.search(r"AS OF SCN (\d+)", dbtable)
        rows = states[int(found[1]) if found else now]
        if "MAX(" in dbtable:
            return rows.agg(F.max("o_orderkey").alias("mark"))
        if isinstance(partition, tm.Split):
            parts = []
            for k in range(len(partition.predicates)):
                part = rows if found else states[next(clock)]
                parts.append(part.filter(F.expr(f"o_orderkey % {len(partition.predicates)} = {k}")))
            return reduce(DataFrame.unionAll, parts)
        return rows

    monkeypatch.setattr(jdbc, "read_table", read_table)
    split = tm.key_split("o_orderkey", 3)
    plan = tm.StreamPlan("T", cursor=None, schema="S", partition=split, one_moment=True)
    tm.sync(spark, SRC, root, [plan])
    assert asked == [jdbc.MOMENT, '"S"."T" AS OF SCN 100']
    found = tm.reconcile(states[100], tm.current(spark, root, "T")).first()
    assert (found.missing, found.extra) == (0, 0)
    asked.clear()
    plan = tm.StreamPlan(
        "T", "incremental", "o_orderkey", "S", split, target="U", one_moment=True
    )
    for _ in range(2):
        commit = tm.sync(spark, SRC, root, [plan]).first()
    scns = {re.search(r"SCN (\d+)", q)[1] for q in asked if q != jdbc.MOMENT}
    assert len(scns) == 2 and all("AS OF SCN" in q for q in asked if q != jdbc.MOMENT)
    present = tm.current(spark, root, "U")
    assert present.agg(F.max("o_orderkey")).first()[0] == int(commit.hwm)
    found = tm.reconcile(states[int(max(scns))], present).first()
    assert (found.missing, found.extra) == (0, 0)


def test_only_oracle_knows_moments(spark):
    with pytest.raises(ValueError, match="Oracle"):
        jdbc.moment_of(spark, tm.JdbcSource("jdbc:x", dictionary="ansi"))
    assert jdbc.as_of('"S"."T"', None) == '"S"."T"'
    assert jdbc.max_query("S", "T", "C", 7) == (
        '(SELECT MAX("C") AS "mark" FROM "S"."T" AS OF SCN 7) q'
    )
