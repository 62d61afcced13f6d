"""Streams against batches: any split into micro-batches, restart and replay."""

import time

import golden
import pytest
from golden import rows
from pyspark.sql import functions as F

from logbrook import fixtures, sources, streaming
from logbrook.operators import merge, sequence_faults
from logbrook.plans import rooms, word_count

FOLDER = "/root/testdata/sf0.001"
ONE_FILE = {"maxFilesPerTrigger": 1}


def write_in_order(log, folder, pieces):
    """The log as one file per piece of its sequence, oldest first."""
    last = log.agg(F.max("seq")).first()[0]
    width = -(-(last + 1) // pieces)
    for start in range(0, last + 1, width):
        sources.write_topic(log.where(F.col("seq").between(start, start + width - 1)).coalesce(1), str(folder))
        time.sleep(0.02)
    return str(folder)


def run(start, rows, out):
    query = start(rows, out, out + "-state", streaming.TO_END)
    query.awaitTermination()
    return query


def occupancy(spark, out):
    return streaming.latest_changes(spark, out, "room", "occupants", "room string, occupants bigint")


@pytest.fixture(scope="module")
def golden_log(spark):
    return spark.createDataFrame(golden.LOG, golden.SCHEMA)


@pytest.mark.parametrize("pieces", [1, 3, 12])
def test_golden_alerts_in_pieces(spark, golden_log, tmp_path, pieces):
    path = write_in_order(golden_log, tmp_path / "in", pieces)
    log = sources.stream_topic(spark, path, golden.SCHEMA, ONE_FILE)
    out = str(tmp_path / "alerts")
    query = run(streaming.start_topic, streaming.running_alerts(*golden.topics(log), buckets=pieces), out)
    assert rows(sources.read_topic(spark, out)) == golden.ALERTS
    assert query.lastProgress["batchId"] >= pieces - 1


def test_golden_occupancy_in_pieces(spark, golden_log, tmp_path):
    path = write_in_order(golden_log, tmp_path / "in", 3)
    moves, _ = golden.topics(sources.stream_topic(spark, path, golden.SCHEMA, ONE_FILE))
    out = str(tmp_path / "occupancy")
    run(streaming.start_changes, streaming.running_occupancy(moves), out)
    assert rows(occupancy(spark, out)) == golden.OCCUPANCY

    out = str(tmp_path / "changelog")
    run(streaming.start_topic, streaming.running_occupancy_changelog(moves), out)
    assert rows(sources.read_topic(spark, out)) == golden.CHANGELOG


def test_large_capacities_keep_every_digit(spark, tmp_path):
    log = [(0, golden.CLASSROOM, "A", str(2**63 - 1)), (1, golden.STUDENT, "s1", "A"), (2, golden.CLASSROOM, "A", "0")]
    path = write_in_order(spark.createDataFrame(log, golden.SCHEMA), tmp_path / "in", 2)
    out = str(tmp_path / "out")
    inputs = golden.topics(sources.stream_topic(spark, path, golden.SCHEMA, ONE_FILE))
    run(streaming.start_topic, streaming.running_alerts(*inputs), out)
    assert rows(sources.read_topic(spark, out)) == {(2, 0, "A", "1")}


def test_events_in_pieces_with_a_restart(spark, tmp_path):
    """Three files, stop, two more files, go on from the checkpoint; then all again from nothing."""
    inputs = fixtures.moves(spark, FOLDER), fixtures.capacities(spark, FOLDER)
    log = merge(*inputs).select("seq", "topic", "key", "value")
    middle = log.agg(F.floor(F.max("seq") / 2)).first()[0]
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    write_in_order(log.where(F.col("seq") <= middle), path, 3)
    stream = golden.topics(sources.stream_topic(spark, path, golden.SCHEMA, ONE_FILE))
    run(streaming.start_topic, streaming.running_alerts(*stream), out)
    write_in_order(log.where(F.col("seq") > middle), path, 4)
    run(streaming.start_topic, streaming.running_alerts(*stream), out)
    expected = rows(rooms.overflow_alerts(*inputs))
    assert rows(sources.read_topic(spark, out)) == expected

    replay = str(tmp_path / "replay")
    run(streaming.start_topic, streaming.running_alerts(*stream), replay)
    assert rows(sources.read_topic(spark, replay)) == expected


@pytest.mark.parametrize("pieces", [(4, 1), (1, 5), (3, 3)])
def test_two_topics_that_arrive_apart(spark, tmp_path, pieces):
    """Folders of unequal file counts, one file at a time, against the batch."""
    inputs = fixtures.moves(spark, FOLDER), fixtures.capacities(spark, FOLDER)
    end = 1 + max(log.agg(F.max("seq")).first()[0] for log in inputs)
    streams = []
    for name, log, count in zip(("student", "classroom"), inputs, pieces):
        path = write_in_order(log.select("seq", "key", "value"), tmp_path / name, count)
        sources.close_topic(spark, path, end)
        streams.append(sources.stream_topic(spark, path, "seq bigint, key string, value string", ONE_FILE))
    out = str(tmp_path / "out")
    run(streaming.start_topic, streaming.running_alerts_aligned(*streams, buckets=8), out)
    assert sorted(map(tuple, sources.read_topic(spark, out).collect())) == sorted(map(tuple, rooms.overflow_alerts(*inputs).collect()))


def test_rows_wait_for_the_other_topic(spark, tmp_path):
    """While a topic is open, what lies beyond its last record waits, over a restart too."""
    schema = "seq bigint, key string, value string"
    logs = {"student": [(0, "s1", "A"), (1, "s2", "A"), (5, "s3", "A")], "classroom": [(2, "A", "1"), (4, "B", "x")]}
    streams, paths = [], []
    for name, log in logs.items():
        paths.append(sources.write_topic(spark.createDataFrame(log, schema).coalesce(1), str(tmp_path / name)))
        streams.append(sources.stream_topic(spark, paths[-1], schema))
    out = str(tmp_path / "out")
    run(streaming.start_topic, streaming.running_alerts_aligned(*streams, buckets=2), out)
    assert rows(sources.read_topic(spark, out)) == {(2, 0, "A", "2")}
    for path in paths:
        sources.close_topic(spark, path, 9)
    run(streaming.start_topic, streaming.running_alerts_aligned(*streams, buckets=2), out)
    assert rows(sources.read_topic(spark, out)) == {(2, 0, "A", "2"), (5, 1, "A", "3")}


def test_whole_tables_in_a_log_of_changes_over_restarts(spark, golden_log, tmp_path):
    """One batch a start, a whole table after each second one, then after each; what is older is neither listed nor needed."""
    out, path = str(tmp_path / "occupancy"), str(tmp_path / "in")
    (tmp_path / "in").mkdir()
    moves, _ = golden.topics(sources.stream_topic(spark, path, golden.SCHEMA, ONE_FILE))
    for every, part in ((2, golden_log.where("seq < 4")), (1, golden_log.where("seq >= 4"))):
        start = lambda rows, *to: streaming.start_changes(rows, *to, "room", "occupants", every=every)  # noqa: B023,E731
        write_in_order(part, path, 3)
        run(start, streaming.running_occupancy(moves, buckets=2), out)
        if every == 2:
            assert {folder.name for folder in tmp_path.glob("occupancy/since=*")} == {"since=-1", "since=1"}
            partly = rows(occupancy(spark, out))
            listed = occupancy(spark, out).inputFiles()
            assert listed and all("/since=1/" in file for file in listed)
            assert streaming.forget_changes(spark, out) == [-1] and streaming.forget_changes(spark, out) == []
            assert {folder.name for folder in tmp_path.glob("occupancy/since=*")} == {"since=1"}
            assert rows(occupancy(spark, out)) == partly
    assert rows(occupancy(spark, out)) == golden.OCCUPANCY
    assert len({file.split("/batch=")[1].split("/")[0] for file in occupancy(spark, out).inputFiles()}) == 1


def test_word_counts_in_pieces(spark, tmp_path):
    lines = fixtures.text_lines(spark, FOLDER)
    schema = "topic string, seq bigint, key string, value string"
    path = write_in_order(lines, tmp_path / "in", 3)
    out = str(tmp_path / "out")
    stream = sources.stream_topic(spark, path, schema, ONE_FILE)
    run(streaming.start_changes, streaming.running_word_counts(stream), out)
    counts = streaming.latest_changes(spark, out, "word", "n", "word string, n bigint")
    assert rows(counts) == rows(word_count.word_count(lines))
    assert spark.read.parquet(out).where("batch >= 0").select("batch").distinct().count() == 3


def test_session_settings_are_left_alone(spark, golden_log, tmp_path):
    names = ("spark.sql.shuffle.partitions", "spark.sql.streaming.stateStore.providerClass")
    before = [spark.conf.get(name, None) for name in names]
    path = write_in_order(golden_log, tmp_path / "in", 1)
    moves, _ = golden.topics(sources.stream_topic(spark, path, golden.SCHEMA))
    run(streaming.start_changes, streaming.running_occupancy(moves), str(tmp_path / "out"))
    assert [spark.conf.get(name, None) for name in names] == before


def test_timed_trigger_follows_a_growing_topic(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    moves = spark.createDataFrame([row for row in golden.LOG if row[1] == golden.STUDENT], golden.SCHEMA)
    write_in_order(moves.where("seq < 3"), path, 1)
    stream = sources.stream_topic(spark, path, golden.SCHEMA)
    query = streaming.start_changes(streaming.running_occupancy(stream), out, out + "-state")
    try:
        query.processAllAvailable()
        assert rows(occupancy(spark, out)) == {("A", 2)}
        write_in_order(moves.where("seq >= 3"), path, 1)
        query.processAllAvailable()
        assert rows(occupancy(spark, out)) == golden.OCCUPANCY
    finally:
        query.stop()


def test_text_lines_to_a_broker(spark, tmp_path):
    """A file format stands in for the connector: it gets the same two columns."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "lines.txt").write_text("one two\n\ntwo, TWO")
    lines = sources.stream_lines(spark, str(tmp_path / "in"))
    records = lines.select("key", "value")
    options = {"path": str(tmp_path / "out")}
    query = streaming.start_broker(
        records, "key", "value", "parquet", "lines", options, str(tmp_path / "state"), streaming.TO_END
    )
    query.awaitTermination()
    assert {tuple(row) for row in spark.read.parquet(options["path"]).collect()} == {
        (None, "one two"), (None, ""), (None, "two, TWO"),
    }
    counts = word_count.word_count(sources.read_lines(spark, str(tmp_path / "in")))
    assert rows(counts) == {("one", 1), ("two", 3), ("", 1)}


def test_counts_to_a_broker_are_wire_bytes(spark, tmp_path):
    counts = word_count.word_count(spark.createDataFrame([("a b a",)], "value string"))
    sources.write_broker(counts, "parquet", "counts", {"path": str(tmp_path / "out")}, "word", "n")
    found = {row.key: bytes(row.value) for row in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert found == {"a": (2).to_bytes(8, "big"), "b": (1).to_bytes(8, "big")}


def test_sequence_check_over_a_restart(spark, tmp_path):
    """Holes that later records fill, repeats over batches, blocks without records, records without a number."""
    schema = "topic string, seq bigint"
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    pieces = [[3, 4, 9, 9, 40], [5, 4, 100, 101], [0, 6, 41, 9, None]]
    log = [spark.createDataFrame([("t", seq) for seq in piece] + [("u", piece[0]), (None, 1)], schema) for piece in pieces]
    (tmp_path / "in").mkdir()
    check = streaming.running_sequence_check(sources.stream_topic(spark, path, schema, ONE_FILE), bits=3)
    for upto, piece in enumerate(log, 1):
        sources.write_topic(piece.coalesce(1), path)
        run(streaming.start_topic, check, out)
        found = streaming.sequence_faults_so_far(sources.read_topic(spark, out))
        expected = sequence_faults(merge(*log[:upto]).where("seq IS NOT NULL"))
        assert rows(found.select("topic", "seq", "fault", "n")) == rows(expected.select("topic", "seq", "fault", "n"))


def test_processors_get_packed_rows(spark, tmp_path):
    """Spark hands over rows one by one, so 3,000 moves of 300 students come as some pieces by bucket."""
    moves = spark.range(3000).selectExpr("id AS seq", "string(id % 300) AS key", "string(id % 7) AS value")
    path, out = write_in_order(moves, tmp_path / "in", 1), str(tmp_path / "out")
    stream = sources.stream_topic(spark, path, moves.schema)
    query = run(streaming.start_topic, streaming.running_occupancy_changelog(stream, buckets=4), out)
    found = sources.read_topic(spark, out).select("seq", "sub", "room", "occupants")
    assert rows(found) == rows(rooms.room_occupancy_changelog(moves).select("seq", "sub", "room", "occupants"))
    state = query.lastProgress["stateOperators"]
    assert all(operator["numRowsUpdated"] <= 4 * 2 for operator in state)
    plan = query._jsq.explainInternal(False)
    assert plan.count("MapInArrow") == 2


def test_state_is_in_a_bounded_number_of_partitions(spark, golden_log, tmp_path):
    """However many the session shuffles into; it is left with its own number."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    path = write_in_order(golden_log, tmp_path / "in", 1)
    moves, _ = golden.topics(sources.stream_topic(spark, path, golden.SCHEMA))
    try:
        spark.conf.set(name, "1000")
        query = run(streaming.start_changes, streaming.running_occupancy(moves, buckets=2), str(tmp_path / "out"))
        assert spark.conf.get(name) == "1000"
    finally:
        spark.conf.set(name, before)
    assert rows(occupancy(spark, str(tmp_path / "out"))) == golden.OCCUPANCY
    most = 4 * spark.sparkContext.defaultParallelism
    assert all(operator["numShufflePartitions"] <= most for operator in query.lastProgress["stateOperators"])
