"""Plans with many small blocks against the SQL over whole tables, and what the plans read."""

import duckdb
import pytest

import __spark_entry__ as registered
from logbrook import fixtures, functions, sources
from logbrook.plans import rooms, word_count
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"
PLANS = {
    "room_deltas": (rooms.room_deltas, ("moves",)),
    "room_occupancy_changelog": (rooms.room_occupancy_changelog, ("moves",)),
    "room_change_stream": (rooms.room_change_stream, ("moves", "capacities")),
    "overflow_alerts": (rooms.overflow_alerts, ("moves", "capacities")),
    "word_count_changelog": (word_count.word_count_changelog, ("text_lines",)),
}


@pytest.mark.parametrize("bits", [2, 6])
@pytest.mark.parametrize("name", sorted(PLANS))
def test_small_blocks_equal_sql(spark, name, bits):
    plan, inputs = PLANS[name]
    result = plan(*[getattr(fixtures, source)(spark, FOLDER) for source in inputs], bits=bits)
    duck = duckdb.connect()
    for table in ("documents", "events"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    expected = duck.execute(registered.log_sql()[name])
    columns = [column[0] for column in expected.description]
    assert sorted(map(str, map(tuple, result.select(columns).collect()))) == sorted(map(str, expected.fetchall()))


def test_occupancy_reads_the_log_once(spark):
    occupancy = rooms.room_occupancy(fixtures.moves(spark, FOLDER))
    occupancy.collect()
    plan = occupancy._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("FileScan") == 1


def test_lines_end_at_carriage_returns_unless_copied(spark, tmp_path):
    (tmp_path / "typed.txt").write_bytes(b"A,5\r\nB,6\rC,7\n")
    lines = sources.read_lines(spark, str(tmp_path)).select(F.col("value").alias("line"))
    found = sources.parse_keyed_lines(lines).collect()
    assert [(r["key"], r["value"]) for r in found] == [("A", "5"), ("B", "6"), ("C", "7")]
    assert [r["value"] for r in sources.read_lines(spark, str(tmp_path), verbatim=True).collect()] == ["A,5\r", "B,6\rC,7"]


def test_strict_numbers_fail(spark):
    frame = spark.createDataFrame([("5",), (None,), ("+7",)], "t string")
    assert [r[0] for r in frame.select(functions.parse_long(F.col("t"), strict=True)).collect()] == [5, None, 7]
    with pytest.raises(Exception, match="not a 64-bit number"):
        frame.select(functions.parse_long(F.lit(" 5"), strict=True)).collect()
