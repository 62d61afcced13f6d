"""Placing of input rows on tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(rows: DataFrame, partitions: int | None, *by: str) -> DataFrame:
    """Deal rows out to more tasks before expensive per-row work, on ``by`` or in turn; None leaves them as they are.

    A table of a few row groups is read by a few tasks, however many cores
    wait. Only the caller knows whether that is so and worth a shuffle.
    """
    return rows if partitions is None else rows.repartition(partitions, *by)
