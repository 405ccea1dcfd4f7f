"""Every registered query against DuckDB on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry_point

duckdb = pytest.importorskip("duckdb")
DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in os.listdir(DATA):
        table = name.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{name}'")
    return connection


def normal(value):
    if value is None or value != value:
        return None
    return float(value) if isinstance(value, float) else value


def canonical(rows, columns):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def test_each_query_has_sql():
    assert set(entry_point.QUERIES) == set(entry_point.ORACLE)
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", list(entry_point.oracle_sql()))
def test_query_equals_sql(spark, sql, name):
    found = entry_point.queries()[name](spark, DATA)
    result = sql.execute(entry_point.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(found.columns) == sorted(columns)
    expected = canonical(result.fetchall(), columns)
    assert canonical([tuple(r) for r in found.collect()], found.columns) == expected


def test_flagship(spark):
    assert entry_point.entry(spark).columns == ["split", "rows", "duration_seconds", "duration_hours"]
