"""Room queries computed in each micro-batch by the batch operators."""

import golden
import pytest
from golden import rows
from pyspark.sql import functions as F
from test_streaming import FOLDER, ONE_FILE, run, write_in_order

from logbrook import fixtures, sources, streaming
from logbrook.operators import merge
from logbrook.plans import rooms
from logbrook.streaming import by_batch

ALERTS = "seq bigint, sub int, room string, status string"
CHANGELOG = "seq bigint, sub int, room string, occupants bigint"


@pytest.mark.parametrize("pieces", [1, 4])
def test_golden_log_in_pieces(spark, tmp_path, pieces):
    path = write_in_order(spark.createDataFrame(golden.LOG, golden.SCHEMA), tmp_path / "in", pieces)
    moves, capacities = golden.topics(sources.stream_topic(spark, path, golden.SCHEMA, ONE_FILE))
    out = str(tmp_path / "alerts")
    streaming.start_alerts(moves, capacities, out, f"{out}-state", streaming.TO_END, bits=1, every=2).awaitTermination()
    assert rows(streaming.batch_results(spark, out, ALERTS)) == golden.ALERTS
    out = str(tmp_path / "changelog")
    run(lambda rows, *to: streaming.start_occupancy_changelog(rows, *to, every=3), moves, out)
    assert rows(streaming.batch_results(spark, out, CHANGELOG)) == golden.CHANGELOG


def test_a_restart_with_more_partitions(spark, tmp_path):
    """Three files, a stop, four more with other settings, against the batch; then the last batch once more."""
    inputs = fixtures.moves(spark, FOLDER), fixtures.capacities(spark, FOLDER)
    log = merge(*inputs).select("seq", "topic", "key", "value")
    middle = log.agg(F.floor(F.max("seq") / 2)).first()[0]
    path, out, name = str(tmp_path / "in"), str(tmp_path / "out"), "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    try:
        for part, pieces, partitions in ((log.where(F.col("seq") <= middle), 3, "2"), (log.where(F.col("seq") > middle), 4, "7")):
            write_in_order(part, path, pieces)
            spark.conf.set(name, partitions)
            topics = golden.topics(sources.stream_topic(spark, path, golden.SCHEMA, ONE_FILE))
            start = lambda rows, *to: streaming.start_alerts(rows, topics[1], *to, bits=5, every=2)  # noqa: B023,E731
            query = run(start, topics[0], out)
    finally:
        spark.conf.set(name, before)
    expected = rows(rooms.overflow_alerts(*inputs))
    assert rows(streaming.batch_results(spark, out, ALERTS)) == expected

    last = query.lastProgress["batchId"]
    (tmp_path / "out-state" / "commits" / str(last)).unlink()
    (tmp_path / "out-state" / "commits" / f".{last}.crc").unlink(missing_ok=True)
    run(start, topics[0], out)
    assert rows(streaming.batch_results(spark, out, ALERTS)) == expected


def test_plan_has_no_python_and_cuts_a_hot_room(spark):
    """A room with nearly all moves: its rows are read in blocks, and equal what the batch finds."""
    moves = spark.range(4000).selectExpr("id AS seq", "string(id % 1500) AS key", "if(id % 50 = 0, 'b', 'a') AS value")
    sizes = spark.createDataFrame([(0, "a", "3"), (2500, "b", "1")], "seq bigint, key string, value string")
    first, second = moves.where("seq < 2000").persist(), moves.where("seq >= 2000").persist()
    inside = rooms.student_latest_room(first)
    counts = rooms.room_occupancy(first).join(rooms.capacity_latest(sizes.where("seq < 2000")), "room", "left")
    totals = counts.select("room", F.struct("occupants", "size").alias("state"))
    states = by_batch.batch_states(second, sizes.where("seq >= 2000"), inside, totals, bits=6)
    whole = rooms.room_changes(moves, sizes, bits=6).where("seq >= 2000")
    found = by_batch.matched(states)
    names = ["seq", "sub", "room", "moved", "occupants", "size", "overflow", "prev_overflow"]
    assert rows(found.select(names)) == rows(whole.select(names))
    plan = states._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert "block" in plan


def test_records_without_key_or_value_and_an_empty_batch(spark):
    empty = spark.createDataFrame([], "seq bigint, key string, value string")
    students, totals = spark.createDataFrame([], by_batch.STUDENTS), spark.createDataFrame([], by_batch.TOTALS)
    assert by_batch.batch_states(empty, empty, students, totals).count() == 0
    odd = spark.createDataFrame([(0, None, "a"), (1, "s", None), (2, "s", "a")], empty.schema)
    sizes = spark.createDataFrame([(3, None, "1"), (4, "a", None), (5, "a", "x")], empty.schema)
    states = by_batch.batch_states(odd, sizes, students, totals).select("seq", "sub", "room", "occupants", "size")
    assert rows(states) == {(2, 1, "a", 1, None)}


def test_rooms_of_a_batch_are_found_without_its_windows(spark):
    """The moves go through their window once, however often the rooms they touch are asked for."""
    schema = "seq bigint, key string, value string"
    moves = spark.createDataFrame([(10, "s", "b"), (11, "s", "c"), (12, "t", "c"), (13, "u", None)], schema)
    sizes = spark.createDataFrame([(14, "d", "4"), (15, "e", "x")], schema)
    students = spark.createDataFrame([("s", "a"), ("u", "f")], by_batch.STUDENTS)
    totals = spark.createDataFrame([(room, (1, 2)) for room in "abcdef"], by_batch.TOTALS)
    log = by_batch.opened_log(moves, sizes, students, totals, None, by_batch.Heavy([], []))
    assert log._jdf.queryExecution().optimizedPlan().toString().count("Window [") == 1
    opened = log.where(F.col("seq") == by_batch.OPENING).select("room", "moved", "amount")
    assert rows(opened) == {(room, moved, 1 if moved else 2) for room in "abcd" for moved in (True, False)}
    states = by_batch.batch_states(moves, sizes, students, totals).select("seq", "sub", "room", "occupants", "size")
    assert rows(states) == {
        (10, 0, "a", 0, 2), (10, 1, "b", 2, 2), (11, 0, "b", 1, 2), (11, 1, "c", 2, 2), (12, 1, "c", 3, 2), (14, 0, "d", 1, 4),
    }


@pytest.mark.parametrize("n", [0, 3, 500])
def test_a_topic_in_so_many_files(spark, tmp_path, n):
    records = spark.range(n).selectExpr("id AS seq", "string(id) AS key", "'a' AS value")
    path = sources.write_topic_files(records, str(tmp_path / "in"), 5)
    assert len(list((tmp_path / "in").glob("*.parquet"))) == 5
    assert rows(sources.read_topic(spark, path)) == rows(records)
