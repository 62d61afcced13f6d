"""Running values against brute force, with one key that holds most rows."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from logbrook.operators import PLACE, heavy_keys, running_state
from logbrook.operators.running import time_bits

SCHEMA = "key string, seq bigint, amount bigint, mark string"


def _log(seed, n=400):
    pick = random.Random(seed)
    keys = ["hot"] * 6 + ["a", "b", None]
    seqs = pick.sample(range(3000), n)
    return [(pick.choice(keys), seq, pick.choice([None, 1, -1, 5]), pick.choice([None, None, "x", "y"])) for seq in seqs]


def _expected(log):
    totals, marks, rows = {}, {}, set()
    for key, seq, amount, mark in sorted(log, key=lambda row: row[1]):
        if key is None:
            continue
        before = (totals.get(key), marks.get(key))
        if amount is not None:
            totals[key] = (totals.get(key) or 0) + amount
        if mark is not None:
            marks[key] = mark
        rows.add((key, seq, totals.get(key), marks.get(key), *before))
    return rows


@pytest.mark.parametrize("bits", [0, 3, 7, 18])
@pytest.mark.parametrize("seed", [1, 2])
def test_running_state(spark, bits, seed):
    log = _log(seed)
    frame = spark.createDataFrame(log, SCHEMA).repartition(5)
    found = running_state(
        frame, "key", ["seq"], sums={"total": F.col("amount")}, latest={"last": F.col("mark")}, bits=bits
    ).select("key", "seq", "total", "last", "prev_total", "prev_last")
    assert {tuple(row) for row in found.collect()} == _expected(log)


def test_two_order_columns(spark):
    log = [("k", seq, pos) for seq in range(20) for pos in range(3)]
    frame = spark.createDataFrame(log, "key string, seq bigint, pos int").repartition(4)
    found = running_state(
        frame, "key", ["seq", "pos"], sums={"n": F.lit(1)}, latest={"at": F.col("pos")}, bits=2
    ).collect()
    assert {(row.seq, row.pos): (row.n, row.prev_at) for row in found} == {
        (seq, pos): (i + 1, log[i - 1][2] if i else None) for i, (_, seq, pos) in enumerate(log)
    }


def test_rows_are_shuffled_once(spark):
    frame = spark.createDataFrame(_log(3), SCHEMA)
    found = running_state(frame, "key", ["seq"], sums={"total": F.col("amount")}, bits=5).select("seq", "total")
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("ReusedExchange") == 1
    assert plan.count("SortMergeJoin") == 1 and "Broadcast" not in plan


def test_no_task_gets_a_whole_hot_key(spark):
    n = 4096
    frame = spark.range(n).select(F.lit("hot").alias("key"), F.col("id").alias("seq"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = running_state(frame, "key", ["seq"], sums={"n": F.lit(1)}, bits=6)
        placed = found.where("n = seq + 1").withColumn("task", F.spark_partition_id())
        sizes = [row["count"] for row in placed.groupBy("task").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == n and max(sizes) < n / 2


@pytest.mark.parametrize("heavy", [[], ["hot"], ["hot", "a"], ["absent"], ["hot", "a", "b"]])
@pytest.mark.parametrize("bits", [0, 3, 18])
def test_only_heavy_keys_are_cut(spark, bits, heavy):
    log = _log(5)
    frame = spark.createDataFrame(log, SCHEMA).repartition(5)
    found = running_state(
        frame, "key", ["seq"], sums={"total": F.col("amount")}, latest={"last": F.col("mark")}, bits=bits, heavy=heavy
    ).select("key", "seq", "total", "last", "prev_total", "prev_last")
    assert {tuple(row) for row in found.collect()} == _expected(log)


def _final_plan(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_light_keys_are_shuffled_once_and_merged_with_nothing(spark):
    frame = spark.createDataFrame(_log(3), SCHEMA)
    light = _final_plan(running_state(frame, "key", ["seq"], sums={"total": F.col("amount")}, heavy=[]))
    assert light.count("Exchange") == 1 and "Join" not in light and "Aggregate" not in light
    both = _final_plan(running_state(frame, "key", ["seq"], sums={"total": F.col("amount")}, bits=5, heavy=["hot"]).select("seq", "total"))
    assert both.count("ReusedExchange") == 1 and both.count("SortMergeJoin") == 1 and "Broadcast" not in both


def test_no_task_gets_a_whole_hot_key_beside_light_ones(spark):
    n = 4096
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 700))
    frame = spark.range(n).select(key.alias("key"), F.col("id").alias("seq"))
    (heavy,) = heavy_keys(frame, ("key", 256), one_in=2)
    assert heavy == ["hot"]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = running_state(frame, "key", ["seq"], sums={"n": F.lit(1)}, bits=6, heavy=heavy)
        placed = found.where("key = 'hot'").withColumn("task", F.spark_partition_id())
        sizes = [row["count"] for row in placed.groupBy("task").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == -(-n // 3) and max(sizes) < n / 6


def test_heavy_keys_of_odd_columns(spark):
    rows = [("a", 1)] * 40 + [(None, 2)] * 50 + [("b", None)] * 3 + [("c", 3)]
    frame = spark.createDataFrame(rows, "key string, number int").repartition(4)
    assert heavy_keys(frame, ("key", 10), ("number", 10), one_in=1) == [["a"], [2, 1]]
    assert heavy_keys(frame.where("false"), ("key", 10), ("number", 10)) == [[], []]


def _placed_log(seed, n=300):
    """Two topics of two partitions each, whose offsets and hours repeat."""
    pick = random.Random(seed)
    rows = []
    for topic in ("student", "classroom"):
        for partition in (0, 1):
            hour = 0
            for offset in range(n // 4):
                hour += pick.choice([0, 0, 0, 1, 5])
                stamp = datetime.datetime(2024, 3, 30, 22) + datetime.timedelta(hours=hour)  # over a change of clocks
                rows.append((topic, partition, offset, stamp, pick.choice(["hot", "hot", "hot", "a", None]), pick.choice([1, -1, 5])))
    return rows


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin"])
@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
@pytest.mark.parametrize("bits, heavy", [(None, None), (34, None), (33, ["hot"]), (None, ["hot"]), (None, [])])
def test_order_over_topics_and_partitions(spark, zone, kind, bits, heavy):
    log = _placed_log(7)
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        frame = spark.createDataFrame(log, f"topic string, partition int, seq bigint, timestamp timestamp_ntz, key string, amount bigint")
        frame = frame.withColumn("timestamp", F.expr(f"CAST(timestamp AS {kind})")).repartition(5)
        found = running_state(frame, "key", PLACE, sums={"total": F.col("amount")}, latest={"last": F.col("amount")}, bits=bits, heavy=heavy)
        rows = {tuple(row) for row in found.select("topic", "partition", "seq", "total", "prev_last").collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    state, expected = {}, set()
    for topic, partition, offset, stamp, key, amount in sorted(log, key=lambda row: (row[3], row[0], row[1], row[2])):
        if key is not None:
            total, last = state.get(key, (0, None))
            state[key] = (total + amount, amount)
            expected.add((topic, partition, offset, total + amount, last))
    assert rows == expected


def test_blocks_of_time_follow_the_log(spark):
    frame = spark.range(10_000).select(F.timestamp_seconds(F.col("id") * 10).alias("timestamp"))
    bits = time_bits(frame, "timestamp", rows=100)
    assert 1000 * 1_000_000 <= 1 << bits <= 2000 * 1_000_000
    assert time_bits(frame.where("false"), "timestamp") == 18
