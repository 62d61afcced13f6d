import golden
import pytest
from golden import rows

from logbrook.plans import rooms


@pytest.fixture(scope="module")
def inputs(spark):
    return golden.topics(spark.createDataFrame(golden.LOG, golden.SCHEMA))


@pytest.mark.parametrize("bits", [0, 1, 2, 18])
def test_changes_at_any_block_size(inputs, bits):
    moves, _ = inputs
    assert rows(rooms.room_occupancy_changelog(moves, bits)) == golden.CHANGELOG
    assert rows(rooms.room_change_stream(*inputs, bits)) == golden.CHANGES
    assert rows(rooms.room_status_labelled(*inputs, bits)) == golden.LABELLED
    assert rows(rooms.overflow_alerts(*inputs, bits)) == golden.ALERTS


def test_joins_split_the_change_stream(inputs):
    by_move = rows(rooms.occupancy_join_capacity(*inputs))
    by_setting = rows(rooms.capacity_join_occupancy(*inputs))
    assert by_setting == {(4, "B", 1, 0), (6, "A", 2, 5)}
    assert by_move | {(seq, 0, *rest) for seq, *rest in by_setting} == golden.CHANGES


def test_tables(inputs):
    moves, capacities = inputs
    assert rows(rooms.room_occupancy(moves)) == golden.OCCUPANCY
    assert rows(rooms.capacity_latest(capacities)) == golden.CAPACITY
    assert rows(rooms.student_latest_room(moves)) == {("s1", "B"), ("s2", "B"), ("s3", "B")}
    assert rows(rooms.room_overflow_latest(moves, capacities)) == {("A", -5), ("B", 3)}


def test_bad_capacity_is_rejected_not_applied(inputs):
    assert [row.seq for row in rooms.capacity_rejects(inputs[1]).collect()] == [10]


def test_defaults_fill_what_one_topic_lacks(spark):
    log = [(0, golden.STUDENT, "s1", "A"), (1, golden.CLASSROOM, "B", "4")]
    found = rooms.room_defaults(*golden.topics(spark.createDataFrame(log, golden.SCHEMA)))
    assert rows(found) == {("A", 1, 2**63 - 1), ("B", 0, 4)}


def test_large_capacities_keep_every_digit(spark):
    log = [(0, golden.CLASSROOM, "A", str(2**63 - 1)), (1, golden.STUDENT, "s1", "A")]
    found = rooms.room_change_stream(*golden.topics(spark.createDataFrame(log, golden.SCHEMA)))
    assert rows(found) == {(1, 1, "A", 1, 2**63 - 1)}


def test_occupants_add_up_to_students(spark):
    from logbrook import fixtures

    moves = fixtures.moves(spark, "/root/testdata/sf0.001")
    students = moves.select("key").distinct().count()
    assert rooms.room_occupancy(moves).agg({"occupants": "sum"}).first()[0] == students
    assert rooms.room_deltas(moves).agg({"delta": "sum"}).first()[0] == students


def test_lowest_capacity_wraps_around(spark):
    log = [(0, golden.CLASSROOM, "A", str(-(2**63))), (1, golden.STUDENT, "s1", "A"), (2, golden.CLASSROOM, "A", "-5")]
    inputs = golden.topics(spark.createDataFrame(log, golden.SCHEMA))
    assert rows(rooms.room_overflow(*inputs)) == {(1, 1, "A", 1 - 2**63), (2, 0, "A", 6)}
