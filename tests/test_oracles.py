"""Every registered query against its SQL, on whole tables."""

import os

import duckdb
import pytest

import __spark_entry__ as registered

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("documents", "events")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def _sorted_rows(columns, rows):
    order = [columns.index(name) for name in sorted(columns)]
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def test_every_query_has_sql():
    assert set(registered.log_queries()) == set(registered.log_sql())


@pytest.mark.parametrize("name", sorted(registered.log_queries()))
def test_query_equals_sql(spark, duck, name):
    result = registered.log_queries()[name](spark, FOLDER)
    expected = duck.execute(registered.log_sql()[name])
    columns = [column[0] for column in expected.description]
    assert sorted(result.columns) == sorted(columns)
    assert _sorted_rows(result.columns, result.collect()) == _sorted_rows(columns, expected.fetchall())


def test_entry(spark):
    assert registered.entry(spark).count() == 1240
