"""Differences of row multisets against brute force."""

import sys
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import tidemark as tm
import tidemark.operators.reconcile  # noqa: F401
from tidemark import SchemaDrift, reconcile
from tidemark.operators.multiset import subtract_all

reconciling = sys.modules["tidemark.operators.reconcile"]

ROWS = st.lists(
    st.tuples(st.sampled_from([1, 2, None]), st.sampled_from(["x", "", None])),
    max_size=25,
)


def frame(spark, rows):
    return spark.createDataFrame(rows, "`a.b` int, `c d` string").coalesce(1)


@settings(
    max_examples=12,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(left=ROWS, right=ROWS)
def test_against_counters(spark, left, right):
    a, b = Counter(left), Counter(right)
    got = subtract_all(frame(spark, left), frame(spark, right), step=2)
    assert Counter(map(tuple, got.collect())) == a - b
    turned = frame(spark, right).select("`c d`", "`a.b`")
    for digest in (False, True):
        (row,) = reconcile(frame(spark, left), turned, digest).collect()
        assert (row.n_source, row.n_target) == (len(left), len(right))
        assert (row.missing, row.extra) == ((a - b).total(), (b - a).total())


def test_a_third_of_all_rows_equal(spark):
    """A hot row is spread over tasks and keeps every copy."""
    n = 30_000
    left = spark.range(3 * n).selectExpr("if(id < %d, -1, id) AS id" % n)
    right = spark.range(100).selectExpr("cast(-1 AS bigint) AS id")
    got = subtract_all(left, right, step=1000)
    counts = got.selectExpr("id = -1 AS hot").groupBy("hot").count().collect()
    assert {r.hot: r["count"] for r in counts} == {True: n - 100, False: 2 * n}
    per_task = (
        got.filter("id = -1")
        .selectExpr("spark_partition_id() AS p")
        .groupBy("p")
        .count()
        .collect()
    )
    assert len(per_task) >= 4
    assert max(r["count"] for r in per_task) < 0.6 * n


def test_nested_and_float_values(spark):
    df = spark.sql(
        "SELECT map('a', 1, 'b', 2) m, array(1.5f, float('nan')) v, struct(1 AS x) s, 0d d"
        " UNION ALL SELECT map('b', 2, 'a', 1), array(1.5f, float('nan')), struct(1), -0d"
    )
    for digest in (False, True):
        (row,) = reconcile(df, df.limit(1), digest).collect()
        assert (row.n_source, row.missing, row.extra) == (2, 1, 0)


@pytest.mark.parametrize("digest", [False, True])
def test_unlike_sides_fail_by_name(spark, digest):
    left = spark.sql("SELECT 1 AS a, 'x' AS b")
    with pytest.raises(SchemaDrift, match="b: string against int"):
        reconcile(left, spark.sql("SELECT 1 AS a, 2 AS b"), digest)


def test_swapped_nulls_are_unlike(spark):
    left = spark.sql("SELECT 'x' AS a, cast(NULL AS string) AS b")
    right = spark.sql("SELECT cast(NULL AS string) AS a, 'x' AS b")
    for digest in (False, True):
        (row,) = reconcile(left, right, digest).collect()
        assert (row.missing, row.extra) == (1, 1)


def test_one_shuffle_of_rows(spark, orders):
    plan = reconcile(orders, orders.filter("o_orderkey > 5"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1
    assert "SortMergeJoin" not in text


@pytest.mark.parametrize(
    "left,right",
    [
        ("array(1, 2) AS a, array(3) AS b", "array(1) AS a, array(2, 3) AS b"),
        ("array(1, NULL) AS a", "array(NULL, 1) AS a"),
        ("cast(array() AS array<int>) AS a", "array(cast(NULL AS int)) AS a"),
        ("cast(NULL AS array<int>) AS a", "cast(array() AS array<int>) AS a"),
        ("struct(1 AS x, cast(NULL AS int) AS y) AS s", "struct(cast(NULL AS int) AS x, 1 AS y) AS s"),
        ("array(struct('a' AS x, 'b' AS y)) AS s", "array(struct('b' AS x, 'a' AS y)) AS s"),
        ("array(array(1), array(2, 3)) AS a", "array(array(1, 2), array(3)) AS a"),
    ],
)
def test_unlike_nested_rows_have_unlike_hashes(spark, left, right):
    for digest in (False, True):
        rows = (spark.sql(f"SELECT {x}") for x in (left, right))
        (row,) = reconcile(*rows, digest).collect()
        assert (row.missing, row.extra) == (1, 1)


def test_maps_below_other_values(spark):
    query = "SELECT struct(map('a', array({0}), 'b', NULL) AS m) AS s, array(map(1, {0})) AS v"
    one, two = (spark.sql(query.format(k)) for k in (1, 2))
    turned = spark.sql(
        "SELECT struct(map('b', cast(NULL AS array<int>), 'a', array(1)) AS m) AS s,"
        " array(map(1, 1)) AS v"
    )
    for left, right, unlike in ((one, two, 1), (one, one, 0), (one, turned, 0)):
        (row,) = reconcile(left, right, digest=True).collect()
        assert (row.missing, row.extra) == (unlike, unlike)


NESTED = st.tuples(
    st.none() | st.lists(st.none() | st.integers(0, 1), max_size=2),
    st.none() | st.tuples(st.none() | st.integers(0, 1), st.none() | st.lists(st.integers(0, 1), max_size=2)),
)


@settings(max_examples=12, deadline=None)
@given(st.lists(NESTED, max_size=8), st.lists(NESTED, max_size=8))
def test_digests_agree_with_rows(spark, left, right):
    schema = "a array<int>, s struct<x:int,y:array<int>>"
    frames = [spark.createDataFrame(rows, schema) for rows in (left, right)]
    assert reconcile(*frames, digest=True).collect() == reconcile(*frames).collect()


# --- by ranges ------------------------------------------------------------------------

KEYED = st.lists(
    st.tuples(st.sampled_from([None, -7, 0, 1, 5, 900]), st.sampled_from(["x", None])),
    max_size=20,
)


@settings(
    max_examples=8,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(
    left=KEYED,
    right=KEYED,
    kind=st.sampled_from(["int", "double", "string", "decimal(9,2)", "date", "timestamp_ntz"]),
    at_once=st.sampled_from([0, 10**6]),
)
def test_ranges_against_counters(spark, left, right, kind, at_once):
    def side(rows):
        df = spark.createDataFrame(rows, "k int, `s t` string").coalesce(1)
        if kind in ("date", "timestamp_ntz"):
            return df.withColumn("k", F.date_add(F.lit("2020-01-01"), F.col("k")).cast(kind))
        value = F.col("k").cast(kind)
        if kind == "double":
            value = F.when(F.col("k") == 900, F.lit(float("nan"))).otherwise(value)
        return df.withColumn("k", value)

    a, b = Counter(left), Counter(right)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(reconciling, "ROWS_AT_ONCE", at_once)
        found = tm.reconcile_ranges(side(left), side(right).select("`s t`", "k"), "k", 4).collect()
    assert sum(r["missing"] for r in found) == (a - b).total()
    assert sum(r["extra"] for r in found) == (b - a).total()
    assert Counter((r["s t"], r["missing"], r["extra"]) for r in found) == Counter(
        (row[1], (a - b)[row], (b - a)[row]) for row in (a - b) + (b - a)
    )


def test_only_unlike_ranges_are_compared(spark, tmp_path):
    folder = f"file:{tmp_path}"
    rows = spark.range(100_000).selectExpr("id AS k", "cast(id % 7 AS string) AS s")
    rows.write.parquet(f"{folder}/a")
    rows.filter("k != 41").unionAll(rows.filter("k = 99000")).write.parquet(f"{folder}/b")
    a, b = (spark.read.parquet(f"{folder}/{x}") for x in "ab")
    assert tm.reconcile_ranges(a, a, "k").rdd.getNumPartitions() <= 1
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(reconciling, "ROWS_AT_ONCE", 10)
        found = tm.reconcile_ranges(a, b, "k", 100)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(" in plan
    assert sorted(map(tuple, found.collect())) == [(41, "6", 1, 0), (99_000, "6", 0, 1)]
    with pytest.raises(SchemaDrift, match="missing"):
        both = a.withColumn("missing", F.lit(1))
        tm.reconcile_ranges(both, both, "k")


def test_ranges_of_a_hot_and_wide_key(spark):
    """A third of the rows share a key; others lie 10**17 apart."""
    df = spark.range(3000).selectExpr(
        "if(id % 3 = 0, 7L, id * 100000000000000) AS k", "id % 5 AS v"
    )
    other = df.withColumn("v", F.expr("if(k = 7 AND v = 1, 2L, v)"))
    found = {tuple(r) for r in tm.reconcile_ranges(df, other, "k").collect()}
    assert found == {(7, 1, 200, 0), (7, 2, 0, 200)}


def test_many_streams_at_once(spark):
    sides = {
        "a": (spark.range(10), spark.range(3, 12)),
        "none": (spark.range(0), spark.range(0)),
        "texts": (
            frame(spark, [(1, "x"), (1, "x"), (2, None)]),
            frame(spark, [(1, "x"), (2, None)]).select("`c d`", "`a.b`"),
        ),
    }
    many = tm.reconcile_many(sides)
    found = {r["stream"]: tuple(r)[1:] for r in many.collect()}
    assert found == {n: tuple(tm.reconcile(*s, digest=True).first()) for n, s in sides.items()}
    assert found["none"] == (0, 0, 0, 0)
    with pytest.raises(SchemaDrift):
        tm.reconcile_many({"x": (spark.range(1), frame(spark, [(1, "x")]))})
