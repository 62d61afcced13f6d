"""Jobs that keep and check logs: retention, comparison, gaps and repeats."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logbrook.operators.running import BLOCK_BITS, running_state

# Fixed value: the default time a record is kept, in hours.
RETENTION_HOURS = 168

# How many offsets share a digest, as a power of two.
RANGE_BITS = 14


def retained(
    records: DataFrame, time: str = "timestamp", hours: int = RETENTION_HOURS, from_seq: int | None = None
) -> DataFrame:
    """Records no older than ``hours`` before the newest and not below ``from_seq``.

    The bound is one value found first, so the scan can skip row groups by it.
    """
    oldest = records.agg(F.max(time) - F.make_interval(hours=F.lit(hours))).scalar()
    kept = records.where(F.col(time) >= oldest)
    return kept if from_seq is None else kept.where(F.col("seq") >= from_seq)


def log_differences(left: DataFrame, right: DataFrame, only_different: bool = True) -> DataFrame:
    """Rows that two copies of a log do not hold equally often, with both counts.

    One grouping serves both directions, and copies combine before the shuffle.
    """
    columns = left.columns
    sides = left.withColumn("side", F.lit(True)).unionByName(right.withColumn("side", F.lit(False)))
    counted = sides.groupBy(*columns).agg(
        F.count_if("side").alias("n_left"), F.count_if(~F.col("side")).alias("n_right")
    )
    return counted.where(F.col("n_left") != F.col("n_right")) if only_different else counted


# How many differing ranges are sent to all tasks; with more, all rows are compared.
FEW_RANGES = 100_000


def log_differences_by_range(
    left: DataFrame, right: DataFrame, key: str = "topic", seq: str = "seq", bits: int = RANGE_BITS, few: int = FEW_RANGES
) -> DataFrame:
    """The rows of ``log_differences``, found by comparing digests of ranges of 2**``bits`` offsets first.

    One digest per (``key``, range) is combined before its shuffle, and no row of
    ranges that are equal is shuffled. Rows of the others are compared one by one;
    where more than ``few`` ranges differ, all rows are. A digest is the count and
    the sums of two 64-bit hashes of each row, in any order, left less right: a
    range that differs is taken for equal by a chance of some 2**-100 only. Rows
    without an offset are one range, and a null equals a null.
    """
    place = [F.col(key).alias("_key"), F.shiftright(seq, bits).alias("_range")]
    sides = left.withColumn("_sign", F.lit(1)).unionByName(right.withColumn("_sign", F.lit(-1)))
    sums = sides.groupBy(*place).agg(*_digest(left.columns, F.col("_sign")))
    unequal = reduce(Column.__or__, [F.col(name) != 0 for name in sums.columns[2:]])
    differing = sums.where(unequal).select("_key", "_range").limit(few + 1).collect()
    if len(differing) <= few:
        kinds = sums.select("_key", "_range").schema
        ranges = F.broadcast(left.sparkSession.createDataFrame(differing, kinds))
        inside = F.col(key).eqNullSafe(F.col("_key")) & F.shiftright(seq, bits).eqNullSafe(F.col("_range"))
        left, right = (side.join(ranges, inside, "left_semi") for side in (left, right))
    return log_differences(left, right)


def _digest(columns: list[str], sign: Column) -> list[Column]:
    """Left rows less right ones, in halves that 2**31 rows do not overflow. A hash passes over nulls, so they are marked."""
    values = [*map(F.col, columns), *[F.col(column).isNull() for column in columns]]
    hashes = [F.xxhash64(*values), F.xxhash64(F.lit("second"), *values)]
    halves = [half for h in hashes for half in (h.bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(h, 32))]
    return [F.sum(sign * half).alias(f"_sum{at}") for at, half in enumerate([F.lit(1), *halves])]


def sequence_faults(records: DataFrame, key: str = "topic", seq: str = "seq", bits: int = BLOCK_BITS) -> DataFrame:
    """Where a log's numbers jump or repeat.

    A row ``gap`` gives the first number after a hole and how many are missing;
    a row ``repeat`` gives a number met more than once and how many times more.
    """
    met = records.groupBy(key, seq).agg(F.count("*").alias("times"))
    linked = running_state(met, key, [seq], latest={"seen": F.col(seq)}, bits=bits)
    faults = F.array(
        _fault("gap", F.col(seq) - F.col("prev_seen") - 1),
        _fault("repeat", F.col("times") - 1),
    )
    return linked.select(key, seq, F.inline(faults)).where("n > 0")


def _fault(name: str, n: Column) -> Column:
    return F.struct(F.lit(name).alias("fault"), n.alias("n"))
