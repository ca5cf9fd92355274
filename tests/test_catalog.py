"""Every registered query gives the rows of its SQL."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from brooklet.catalog import ORACLES, QUERIES
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@pytest.fixture(scope="module")
def database(sf):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    return connection


def plain(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(f"{r[i]:.6f}" if isinstance(r[i], float) else str(r[i]) for i in order) for r in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, sf, database, name):
    df = QUERIES[name](spark, sf)
    rows = df.collect()
    cursor = database.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert plain(rows, df.columns) == plain(cursor.fetchall(), columns)


def test_entry_points_register_every_query():
    assert QUERIES.keys() <= entry_points.queries().keys()
    assert ORACLES.keys() <= entry_points.oracle_sql().keys()


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
