"""Each SQL oracle must notice when one of the easily lost rules is dropped."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
from logbrook import fixtures
from logbrook.plans import rooms

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for table in ("documents", "events"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return lambda name: set(connection.execute(registered.oracle_sql()[name]).fetchall())


def _rows(frame):
    return {tuple(row) for row in frame.collect()}


def test_zero_rows(spark, oracle):
    held = rooms.room_occupancy(fixtures.moves(spark, FOLDER))
    assert _rows(held) == oracle("room_occupancy")
    assert _rows(held.where("occupants > 0")) != oracle("room_occupancy")


def test_retraction(spark, oracle):
    deltas = rooms.room_deltas(fixtures.moves(spark, FOLDER))
    total = F.sum("delta").alias("occupants")
    assert _rows(deltas.groupBy("room").agg(total)) == oracle("room_occupancy")
    assert _rows(deltas.where("delta > 0").groupBy("room").agg(total)) != oracle("room_occupancy")


def test_leading_and_trailing_empty_words(spark, oracle):
    lines = fixtures.text_lines(spark, FOLDER)
    expected = oracle("word_count")
    keep_all = F.split(F.lower("value"), r"\W+")
    keep_none = F.regexp_extract_all(F.lower("value"), F.lit(r"\w+"), F.lit(0))
    for wrong in (keep_all, keep_none):
        counts = lines.select(F.explode(wrong).alias("word")).groupBy("word").count()
        assert _rows(counts) != expected
