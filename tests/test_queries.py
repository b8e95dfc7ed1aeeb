"""Every registered query against its SQL, as whole multisets of rows."""

import os
import sys
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_point

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = entry_point.core_queries(), entry_point.core_sql()


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for name in entry_point.TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')"
        )
    return connection


# Type names of the two engines, where they carry the same values.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, tables, name):
    got = QUERIES[name](spark, SF_DIR)
    want = tables.sql(SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    kinds = dict(zip(want.columns, map(str, want.types), strict=True))
    assert {c: TYPES[t] for c, t in got.dtypes} == kinds
    rows = want.select(*(f'"{c}"' for c in columns)).fetchall()
    assert rows
    assert Counter(map(tuple, got.select(*columns).collect())) == Counter(rows)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == SQL.keys()
    assert QUERIES.keys() <= entry_point.queries().keys()
    assert SQL.keys() <= entry_point.oracle_sql().keys()


@pytest.mark.parametrize("hidden", ["tidemark.llm", "corpus_pipeline"])
def test_the_rest_stands_without_the_optional_queries(monkeypatch, hidden):
    for name in [m for m in sys.modules if m.startswith(hidden) or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, hidden, None)
    with pytest.warns(UserWarning, match="tidemark.llm"):
        assert entry_point.queries().keys() == QUERIES.keys()
    with pytest.warns(UserWarning, match="tidemark.llm"):
        assert entry_point.oracle_sql().keys() == SQL.keys()


def test_entry(spark):
    (row,) = entry_point.entry(spark).collect()
    assert (row.stream, row.n_rows, row.n_cols) == ("orders", 1500, 6)
