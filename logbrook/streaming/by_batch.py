"""Room queries computed micro-batch by micro-batch with the batch operators: no state store, no Python worker.

What earlier batches left behind is kept in two tables, the room of each student
and the occupants and size of each room. The rows a batch touches open its log,
as records that lie before all others; the running values of ``operators.running``
then go on from them. A room with most of a batch is cut into blocks there, as in
a batch, so no task has a whole room.

The tables are logs of changes: a micro-batch reads the newest whole table and
the changes since, so its cost has a scan of the tables in it. That suits large
micro-batches; for small ones at short intervals the processors are cheaper.
Keys are in no buckets, and each micro-batch is planned with the settings of the session
that started the query, so it may go on with any other number of shuffle partitions.

A repeated micro-batch reads the tables as they were before it and replaces what
it wrote. Batches must come in the order of ``seq``, which is not negative.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logbrook.operators import latest_per_key, merge
from logbrook.operators.grouping import complete
from logbrook.plans.rooms import Heavy, alert, capacity_settings, heavy, matched, room_deltas, room_log, room_states
from logbrook.streaming.pipelines import SNAPSHOT_EVERY, ChangeLog, start

STUDENTS = "student string, room string"
TOTALS = "room string, state struct<occupants: bigint, size: bigint>"

# The place of opening records, before every offset and, as a block, no other block's number.
OPENING = -(1 << 60)

SETTINGS = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")

# What a micro-batch keeps lies in partitions as large as its rows ask for, not in all that the session shuffles into.
COALESCED = "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning"


def start_occupancy_changelog(
    moves: DataFrame,
    out: str,
    checkpoint: str,
    trigger: dict | None = None,
    bits: int | None = None,
    every: int = SNAPSHOT_EVERY,
) -> StreamingQuery:
    """Write ``seq, sub, room, occupants`` after every change, a folder per micro-batch; read with ``batch_results``."""

    def changelog(states: DataFrame) -> DataFrame:
        return states.select("seq", "sub", "room", "occupants")

    return _start(_tagged(moves, True), changelog, out, checkpoint, trigger, bits, every)


def start_alerts(
    moves: DataFrame,
    capacities: DataFrame,
    out: str,
    checkpoint: str,
    trigger: dict | None = None,
    bits: int | None = None,
    every: int = SNAPSHOT_EVERY,
) -> StreamingQuery:
    """Write the overflow messages of topics that arrive together, as parts of one log: ``seq, sub, room, status``."""
    log = merge(_tagged(moves, True), _tagged(capacities, False))
    return _start(log, lambda states: alert(matched(states)), out, checkpoint, trigger, bits, every)


def batch_results(spark: SparkSession, out: str, schema: str) -> DataFrame:
    """All rows that such a query has written, each once."""
    return spark.read.schema(schema).parquet(out).drop("batch")


def batch_states(
    moves: DataFrame, capacities: DataFrame, students: DataFrame, totals: DataFrame, bits: int | None = None
) -> DataFrame:
    """The rows of ``room_states`` for records that follow those which led to the two tables."""
    busy = heavy(moves, capacities, bits)
    return _states(opened_log(moves, capacities, students, totals, bits, busy), bits, busy)


def opened_log(
    moves: DataFrame, capacities: DataFrame, students: DataFrame, totals: DataFrame, bits: int | None, busy: Heavy
) -> DataFrame:
    """The rows of ``room_log`` for these records, after openings with what the rooms they touch had before."""
    entered = complete(moves).select("seq", "key", "value")
    inside = students.join(entered.select(F.col("key").alias("student")).distinct(), "student", "left_semi")
    opened = inside.select(_opening(), F.col("student").alias("key"), F.col("room").alias("value"))
    deltas = room_deltas(merge(opened, entered), bits, students=busy.students).where(F.col("seq") > OPENING)
    log = room_log(deltas, capacities)
    # The rooms of the log: those that records name, and those that students who move again are in.
    named = merge(entered.select(F.col("value").alias("room")), inside.select("room"), capacity_settings(capacities).select("room"))
    held = totals.join(named.distinct(), "room", "left_semi").select("room", "state.*")
    openings = [_held(held, "occupants", moved=True), _held(held, "size", moved=False)]
    return merge(log, *openings)


def _states(log: DataFrame, bits: int | None, busy: Heavy) -> DataFrame:
    return room_states(log, bits=bits, busy=busy.rooms).where(F.col("seq") > OPENING)


def _opening() -> Column:
    return F.lit(OPENING).alias("seq")


def _held(totals: DataFrame, name: str, moved: bool) -> DataFrame:
    amount = F.col(name).alias("amount")
    return totals.select(_opening(), F.lit(int(moved)).alias("sub"), "room", F.lit(moved).alias("moved"), amount).where("amount IS NOT NULL")


def _tagged(records: DataFrame, moved: bool) -> DataFrame:
    return records.select("seq", "key", "value", F.lit(moved).alias("moved"))


def _start(
    log: DataFrame,
    result: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    trigger: dict | None,
    bits: int | None,
    every: int,
) -> StreamingQuery:
    spark = log.sparkSession
    students = ChangeLog(spark, f"{out}-students", STUDENTS, "student", "room", every)
    totals = ChangeLog(spark, f"{out}-rooms", TOTALS, "room", "state", every)
    settings = {name: spark.conf.get(name) for name in SETTINGS} | {COALESCED: "true"}

    def write(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        for name, value in settings.items():
            session.conf.set(name, value)
        batch = batch.persist()
        moves, capacities = batch.where("moved"), batch.where("NOT moved")
        busy = heavy(moves, capacities, bits)
        # Kept, as the windows over the rooms and the summaries of their blocks both read it.
        rows = opened_log(
            moves, capacities, students.before(session, number), totals.before(session, number), bits, busy
        ).persist()
        states = _states(rows, bits, busy).persist()
        try:
            result(states).write.mode("overwrite").parquet(f"{out}/batch={number}")
            rooms = F.max_by(F.struct("occupants", "size"), F.struct("seq", "sub")).alias("state")
            totals.write(states.groupBy("room").agg(rooms), number)
            newest = latest_per_key(moves).select(F.col("key").alias("student"), F.col("value").alias("room"))
            students.write(newest, number)
        finally:
            states.unpersist()
            rows.unpersist()
            batch.unpersist()

    return start(log.writeStream.foreachBatch(write), checkpoint, trigger)
