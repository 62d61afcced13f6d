"""Room occupancy against room capacity, as a batch.

Inputs are two topics, moves (student -> room) and capacities (room -> decimal
text), in one order. That is ``seq``, if the topics share such a number, or with
``order=PLACE`` the records' time, then their topic, partition and offset: then
numbers may repeat between partitions and topics, and times may be equal. A
change is ordered by its record and, within a move, by ``sub``: leaving (0)
before entering (1). Results carry the columns of the order.

Students and rooms with more records than a block (2**18, or 2**``bits``) are
found first, by a sketch over the topics, and only they are cut into blocks.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logbrook.functions import parse_long, wrapping_minus
from logbrook.operators import heavy_keys, latest_per_key, merge, regroup_changes, regrouped_counts, running_state
from logbrook.operators.running import BLOCK_BITS, time_bits

Order = Sequence[str]
SEQ = ("seq",)

# What a room without moves and one without a capacity count as.
NO_OCCUPANTS = 0
NO_LIMIT = 9223372036854775807


def student_latest_room(moves: DataFrame, order: Order = SEQ) -> DataFrame:
    """``student, room``."""
    return latest_per_key(moves, order=order).select(F.col("key").alias("student"), F.col("value").alias("room"))


def capacity_settings(capacities: DataFrame, strict: bool = False, order: Order = SEQ) -> DataFrame:
    """The valid settings: their order, ``room, size``. Other text never reaches the table; if ``strict``, it fails the query."""
    size = parse_long(F.col("value"), strict).alias("size")
    return capacities.select(*order, F.col("key").alias("room"), size).where(
        "room IS NOT NULL AND size IS NOT NULL"
    )


def capacity_rejects(capacities: DataFrame) -> DataFrame:
    """The settings whose text is no number."""
    return capacities.where(F.col("value").isNotNull() & parse_long(F.col("value")).isNull())


def capacity_latest(capacities: DataFrame, order: Order = SEQ) -> DataFrame:
    """``room, size``."""
    return latest_per_key(capacity_settings(capacities, order=order), "room", "size", order)


def _limit(bits: int | None) -> int:
    return 1 << (BLOCK_BITS if bits is None else min(bits, BLOCK_BITS))


class Heavy(NamedTuple):
    """Students and rooms with too many records for one task."""

    students: list
    rooms: list


def heavy(moves: DataFrame, capacities: DataFrame | None = None, bits: int | None = None) -> Heavy:
    """Found in one pass over the topics. A move changes two rooms, the one it names and one that a move before it named."""
    limit = 1 << (BLOCK_BITS if bits is None else min(bits, BLOCK_BITS))
    log = moves.select(F.col("key").alias("student"), F.col("value").alias("room"))
    if capacities is not None:
        log = merge(log, capacities.select(F.col("key").alias("room")), fill=True)
    return Heavy(*heavy_keys(log, ("student", limit), ("room", limit // 2)))


def room_deltas(
    moves: DataFrame, bits: int | None = None, order: Order = SEQ, students: Sequence | None = None
) -> DataFrame:
    """The moves' order, ``sub, room, delta``: what each move does to the rooms."""
    students = heavy(moves, bits=bits).students if students is None else students
    return regroup_changes(moves, order=order, bits=bits, heavy=students).withColumnRenamed("value", "room")


def _bits(moves: DataFrame, busy: list, bits: int | None, order: Order) -> int | None:
    """Blocks of time, where they are needed, are measured on the topic and not on what is computed from it."""
    return time_bits(moves, order[0]) if busy and bits is None and tuple(order) != SEQ else bits


def room_occupancy(moves: DataFrame, order: Order = SEQ) -> DataFrame:
    """``room, occupants``, with the rooms everybody has left."""
    counts = regrouped_counts(moves, order=order)
    return counts.select(F.col("value").alias("room"), F.col("n").alias("occupants"))


def _room_state(log: DataFrame, order: Order, bits: int | None, heavy: list, **steps) -> DataFrame:
    """Running values by room. A ``seq`` and ``sub`` are packed into one number with the same order."""
    if tuple(order) != SEQ:
        return running_state(log, "room", [*order, "sub"], bits=bits, heavy=heavy, **steps)
    packed = log.withColumn("at", F.col("seq") * 2 + F.col("sub")).drop("seq", "sub")
    bits = (BLOCK_BITS if bits is None else bits) + 1
    state = running_state(packed, "room", ["at"], bits=bits, heavy=heavy, **steps)
    unpacked = {"seq": F.shiftright("at", 1), "sub": F.col("at").bitwiseAND(1).cast("int")}
    return state.withColumns(unpacked).drop("at")


def room_occupancy_changelog(moves: DataFrame, bits: int | None = None, order: Order = SEQ) -> DataFrame:
    """The order, ``sub, room, occupants`` after every change."""
    students, busy = heavy(moves, bits=bits)
    log = room_deltas(moves, bits, order, students)
    counted = _room_state(log, order, _bits(moves, busy, bits, order), busy, sums={"occupants": F.col("delta")})
    return counted.select(*order, "sub", "room", "occupants")


def room_changes(
    moves: DataFrame, capacities: DataFrame, bits: int | None = None, order: Order = SEQ
) -> DataFrame:
    """Every change of a room that has both occupants and a capacity on record.

    Gives the order, ``sub, room, occupants, size, overflow, prev_overflow`` and
    ``moved``, which tells an occupancy change from a capacity change. Both
    joins, their merge and the look back at the stored overflow come out of one
    pass over the rooms: a row's joined values are the room's state after it,
    and the overflow stored so far is the state before it.
    """
    students, busy = heavy(moves, capacities, bits)
    log = room_log(room_deltas(moves, bits, order, students), capacities, order)
    state = room_states(log, order, _bits(moves, busy, bits, order), busy)
    return matched(state.select(*order, "sub", "room", "moved", "occupants", "size", "prev_occupants", "prev_size"))


def room_states(log: DataFrame, order: Order = SEQ, bits: int | None = None, busy: Sequence = ()) -> DataFrame:
    """The rows of ``room_log`` with the room's ``occupants, size`` after each, and the same before it under ``prev_``."""
    return _room_state(
        log,
        order,
        bits,
        list(busy),
        sums={"occupants": F.when(F.col("moved"), F.col("amount"))},
        latest={"size": F.when(~F.col("moved"), F.col("amount"))},
    )


def room_log(deltas: DataFrame, capacities: DataFrame, order: Order = SEQ) -> DataFrame:
    """Everything that happens to a room: its order, ``sub, room, moved, amount``.

    The amount is a change of occupants if ``moved``, else a new size.
    """
    moved = deltas.select(*order, "sub", "room", F.lit(True).alias("moved"), F.col("delta").alias("amount"))
    settings = capacity_settings(capacities, order=order).select(
        *order, F.lit(0).alias("sub"), "room", F.lit(False).alias("moved"), F.col("size").alias("amount")
    )
    return merge(moved, settings)


def matched(state: DataFrame) -> DataFrame:
    """The rows at which a room has both occupants and a size, with the overflow now and before."""
    overflow = wrapping_minus(F.col("occupants"), F.col("size"))
    before = wrapping_minus(F.col("prev_occupants"), F.col("prev_size"))
    changes = state.withColumns({"overflow": overflow, "prev_overflow": before}).where(
        "occupants IS NOT NULL AND size IS NOT NULL"
    )
    return changes.drop("prev_occupants", "prev_size")


def occupancy_join_capacity(
    moves: DataFrame, capacities: DataFrame, bits: int | None = None, order: Order = SEQ
) -> DataFrame:
    """Occupancy changes with the capacity in force."""
    return room_changes(moves, capacities, bits, order).where("moved").select(*order, "sub", "room", "occupants", "size")


def capacity_join_occupancy(
    moves: DataFrame, capacities: DataFrame, bits: int | None = None, order: Order = SEQ
) -> DataFrame:
    """Capacity changes with the occupancy at that time."""
    return room_changes(moves, capacities, bits, order).where("NOT moved").select(*order, "room", "occupants", "size")


def room_change_stream(
    moves: DataFrame, capacities: DataFrame, bits: int | None = None, order: Order = SEQ
) -> DataFrame:
    """Both kinds of change together."""
    return room_changes(moves, capacities, bits, order).select(*order, "sub", "room", "occupants", "size")


def room_overflow(
    moves: DataFrame, capacities: DataFrame, bits: int | None = None, order: Order = SEQ
) -> DataFrame:
    """By how much a room is over its capacity, at every change."""
    return room_changes(moves, capacities, bits, order).select(*order, "sub", "room", "overflow")


def room_overflow_latest(moves: DataFrame, capacities: DataFrame, order: Order = SEQ) -> DataFrame:
    """By how much each room is over now. Needs the two latest tables only, which both lie by room."""
    both = room_occupancy(moves, order).join(capacity_latest(capacities, order).hint("merge"), "room")
    return both.select("room", wrapping_minus(F.col("occupants"), F.col("size")).alias("overflow"))


def room_change_with_previous(
    moves: DataFrame, capacities: DataFrame, bits: int | None = None, order: Order = SEQ
) -> DataFrame:
    """Changes with the overflow stored before them; a room's first one has none."""
    changes = room_changes(moves, capacities, bits, order).where("prev_overflow IS NOT NULL")
    return changes.select(*order, "sub", "room", "occupants", "size", "prev_overflow")


def room_status_labelled(
    moves: DataFrame, capacities: DataFrame, bits: int | None = None, order: Order = SEQ
) -> DataFrame:
    """``OK`` where a room is exactly full, else the number of its occupants."""
    label = F.when(F.col("occupants") == F.col("size"), "OK").otherwise(F.col("occupants").cast("string"))
    changes = room_change_with_previous(moves, capacities, bits, order)
    return changes.select(*order, "sub", "room", label.alias("status"))


def alert(changes: DataFrame, order: Order = SEQ) -> DataFrame:
    """Messages only: the occupants while a room is over, ``OK`` once it no longer is."""
    text = F.when(F.col("overflow") > 0, F.col("occupants").cast("string")).otherwise("OK")
    return changes.where("overflow > 0 OR prev_overflow > 0").select(*order, "sub", "room", text.alias("status"))


def overflow_alerts(
    moves: DataFrame, capacities: DataFrame, bits: int | None = None, order: Order = SEQ
) -> DataFrame:
    """The order, ``sub, room, status`` for rooms that go over, stay over or recover."""
    return alert(room_changes(moves, capacities, bits, order), order)


def room_defaults(moves: DataFrame, capacities: DataFrame, order: Order = SEQ) -> DataFrame:
    """All rooms known to either topic: ``room, occupants, size``, gaps filled."""
    both = room_occupancy(moves, order).join(capacity_latest(capacities, order), "room", "full_outer")
    return both.select(
        "room",
        F.coalesce("occupants", F.lit(NO_OCCUPANTS).cast("bigint")).alias("occupants"),
        F.coalesce("size", F.lit(NO_LIMIT)).alias("size"),
    )
