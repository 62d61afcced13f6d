"""Running values along a log, per key, for keys of any size.

A window over a key hands the key's whole history to one task, and one room or
word may hold a third of the log. So the log is cut into blocks of ``2**bits``
consecutive offsets and the window runs inside (key, block). What a block
inherits from the key's earlier blocks is one small row per (key, block),
carried along the blocks by a second window. A block is a function of the
offset alone, so a lost and repeated task sees the same one.

Rows are shuffled once: both the block summaries and the windows read that one
exchange, and the inherited values are merged in on its keys, by which the
windows have sorted the rows already. Nothing is broadcast. Where no key reaches
a second block, adaptive execution finds nothing to join and drops the join.

Blocks are for keys that need them. With ``heavy``, a list of such keys (see
``heavy_keys``), all others have one block, and summaries are carried along for
the listed ones only; with an empty list what is left is a plain window, one
shuffle by key.

The order may be a place in several logs: a time, then topic, partition and
offset. Blocks are then stretches of time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import WindowSpec

BLOCK_BITS = 18

# A record's place among all records of several topics and partitions.
PLACE = ("timestamp", "topic", "partition", "seq")

TRACKED = 10_000


def heavy_keys(rows: DataFrame, *limits: tuple[str, int], one_in: int = 16) -> list[list]:
    """For each (column, limit): the column's values with more than about ``limit`` rows, by a sketch of one row in ``one_in``.

    One pass serves all columns and reads no others. A sketch follows ``TRACKED``
    values and is merged from the tasks' own, so nothing grows with the log. It
    decides how rows are computed, never which: a key taken for a light one is
    still right, and no group of light ones is larger than its limit by more
    than the sketch's error, 3.5 / ``TRACKED`` of the log.
    """
    names = [f"k{at}" for at in range(len(limits))]
    seen = rows.select(*[F.col(column).alias(name) for name, (column, _) in zip(names, limits)])
    tops = [F.expr(f"approx_top_k({name}, {TRACKED}, {TRACKED})") for name in names]
    found = seen.sample(1 / one_in, seed=1).agg(*tops).first()
    return [
        [item["item"] for item in top or [] if item["item"] is not None and item["count"] * one_in > limit]
        for top, (_, limit) in zip(found, limits)
    ]


def time_bits(log: DataFrame, time: str, rows: int = 1 << BLOCK_BITS) -> int:
    """How many low bits of the microseconds make blocks of so many rows of the whole log, if they came evenly."""
    at = _number(log, time)
    first, last, n = log.agg(F.min(at), F.max(at), F.count("*")).first()
    return max(0, ((last - first) * rows // n).bit_length()) if n and last is not None else BLOCK_BITS


def _number(log: DataFrame, column: str) -> Column:
    """An offset as it is, a time as microseconds that grow with it whatever the session's time zone."""
    kind = log.schema[column].dataType
    if isinstance(kind, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{column}`)")
    return F.unix_micros(column) if isinstance(kind, T.TimestampType) else F.col(column)


def running_state(
    log: DataFrame,
    key: str,
    order: Sequence[str],
    sums: Mapping[str, Column] | None = None,
    latest: Mapping[str, Column] | None = None,
    bits: int | None = None,
    heavy: Sequence | None = None,
) -> DataFrame:
    """Add each key's running totals and latest values to every row.

    Under a name in ``sums`` comes the total of its expression up to and with
    the row, under one in ``latest`` the last value that was not null. Either is
    null while there was nothing yet. ``prev_<name>`` is the same before the
    row. Rows without a key are left out. The columns ``order`` must order a key's rows completely; the first is
    the offset or time whose high bits are the block. If ``bits`` is not given, blocks of 2**18
    offsets are taken, or a stretch of time that holds as many rows on average. ``heavy`` keys are cut into
    blocks, all keys if it is not given.
    """
    sums, latest = dict(sums or {}), dict(latest or {})
    keyed = log.where(F.col(key).isNotNull())
    steps = {name: F.sum(value) for name, value in sums.items()}
    steps |= {name: F.last(value, True) for name, value in latest.items()}
    if heavy is not None and not heavy:
        return keyed.withColumns(_windows(steps, Window.partitionBy(key).orderBy(*order)))
    if bits is None:
        timed = isinstance(log.schema[order[0]].dataType, (T.TimestampType, T.TimestampNTZType))
        bits = time_bits(log, order[0]) if timed else BLOCK_BITS
    block = block_of(_number(log, order[0]), bits)
    if heavy is not None:
        block = F.when(F.col(key).isin(list(heavy)), block).otherwise(LIGHT)
    blocked = keyed.withColumn("block", block).repartition(key, "block")
    local = blocked.withColumns(_windows(steps, Window.partitionBy(key, "block").orderBy(*order)))
    inherited = _inherited(blocked, key, order, sums, latest).hint("merge")
    rows = local.join(inherited, [key, "block"], "left")
    joined = {}
    for name in steps:
        carried = F.col(f"carried_{name}")
        for shown in (name, f"prev_{name}"):
            own = F.col(shown)
            joined[shown] = F.coalesce(own + carried, own, carried) if name in sums else F.coalesce(own, carried)
    return rows.withColumns(joined).drop("block", *[f"carried_{name}" for name in steps])


# The block of keys that have one only; offsets and times in use give other numbers.
LIGHT = -(1 << 62)


def _windows(steps: Mapping[str, Column], here: WindowSpec) -> dict[str, Column]:
    upto = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = here.rowsBetween(Window.unboundedPreceding, -1)
    windows = {name: step.over(upto) for name, step in steps.items()}
    return windows | {f"prev_{name}": step.over(before) for name, step in steps.items()}


def block_of(offset: str | Column, bits: int) -> Column:
    """The block an offset lies in. Never null, so that no filter on it is planned
    into one of the two readers of the exchange, which would then not be shared."""
    return F.coalesce(F.shiftright(offset, bits), F.lit(0).cast("bigint"))


def _inherited(
    blocked: DataFrame, key: str, order: Sequence[str], sums: Mapping[str, Column], latest: Mapping[str, Column]
) -> DataFrame:
    """Per (key, block): the state the key's earlier blocks leave behind, if any.

    Blocks are ordered by their last row, not by number: this way the summary
    reads the same columns as the rows do, and both share one exchange. A light
    key's only block inherits nothing, so it is met here in passing alone.
    """
    at = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    per_block = blocked.groupBy(key, "block").agg(
        F.max("block").alias("own_block"),
        *[F.max(column).alias(f"until_{column}") for column in order],
        *[F.sum(value).alias(name) for name, value in sums.items()],
        *[F.max_by(value, F.when(value.isNotNull(), at)).alias(name) for name, value in latest.items()],
    )
    # Asked of the maximum, as a filter on the block itself would be planned below the shared exchange.
    per_block = per_block.where(F.col("own_block") != LIGHT)
    by_block = Window.partitionBy(key).orderBy(*[f"until_{column}" for column in order])
    earlier = by_block.rowsBetween(Window.unboundedPreceding, -1)
    states = {f"carried_{name}": F.sum(name).over(earlier) for name in sums}
    states |= {f"carried_{name}": F.last(name, True).over(earlier) for name in latest}
    carried = per_block.select(key, "block", *[state.alias(name) for name, state in states.items()])
    known = [F.col(name).isNotNull() for name in states]
    return carried.where(reduce(Column.__or__, known))
