"""Tables out of logs: latest value per key, regrouping, retractable counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logbrook.operators.running import running_state


def merge(first: DataFrame, *others: DataFrame, fill: bool = False) -> DataFrame:
    """All rows of several logs of the same columns, copies included. Only with ``fill`` may one lack columns, which are null."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=fill)
    return first


def complete(records: DataFrame, key: str = "key", value: str = "value") -> DataFrame:
    """The records that can enter a table: those with a key and a value."""
    return records.where(F.col(key).isNotNull() & F.col(value).isNotNull())


def place(order: str | Sequence[str]) -> Column:
    """One column, or several as one value that compares like them in turn."""
    return F.col(order) if isinstance(order, str) else F.col(order[0]) if len(order) == 1 else F.struct(*order)


def latest_per_key(
    records: DataFrame, key: str = "key", value: str = "value", order: str | Sequence[str] = "seq"
) -> DataFrame:
    """The last value of each key; combined before the shuffle."""
    return complete(records, key, value).groupBy(key).agg(F.max_by(value, place(order)).alias(value))


def regroup_changes(
    records: DataFrame,
    key: str = "key",
    group: str = "value",
    order: Sequence[str] = ("seq",),
    bits: int | None = None,
    heavy: Sequence | None = None,
) -> DataFrame:
    """What a table's changes mean once it is grouped by its value.

    Each record moves its key into a group: -1 for the group it leaves, if any
    (``sub`` 0), then +1 for the one it enters (``sub`` 1), even when both are
    the same. ``order`` is the records' place, ``heavy`` the keys with more rows than a task should get.
    """
    log = complete(records, key, group).select(key, *order, group)
    moves = running_state(log, key, order, latest={"now": F.col(group)}, bits=bits, heavy=heavy)
    halves = F.array(_half(0, "prev_now", -1), _half(1, group, 1))
    return moves.select(*order, F.inline(halves)).where(F.col("group").isNotNull()).withColumnRenamed("group", group)


def _half(sub: int, group: str, delta: int) -> Column:
    return F.struct(
        F.lit(sub).alias("sub"), F.col(group).alias("group"), F.lit(delta).cast("bigint").alias("delta")
    )


def regrouped_counts(
    records: DataFrame, key: str = "key", group: str = "value", order: str | Sequence[str] = "seq"
) -> DataFrame:
    """How many keys each group holds now; groups all keys have left stay, with 0.

    One small row per (key, group), its last place in the order, is all that is
    needed of the log, so the log is read once and combined before the shuffle.
    A key has as many of these as it has met groups.
    """
    last = complete(records, key, group).groupBy(key, group).agg(F.max(place(order)).alias("at"))
    newest = F.max("at").over(Window.partitionBy(key))
    return last.withColumn("held", F.col("at") == newest).groupBy(group).agg(F.count_if("held").alias("n"))
