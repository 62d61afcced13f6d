"""The test tables seen as topics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logbrook.sources import stream_topic


def table(spark: SparkSession, folder: str, name: str, streaming: bool = False) -> DataFrame:
    """A test table. A stream takes a single file only as a match of a pattern, hence the braces."""
    rows = spark.read.parquet(f"{folder}/{name}.parquet")
    return stream_topic(spark, f"{folder}/{{{name}}}.parquet", rows.schema) if streaming else rows


def text_lines(spark: SparkSession, folder: str, streaming: bool = False) -> DataFrame:
    """Documents as lines without a key."""
    documents = table(spark, folder, "documents", streaming)
    return documents.select(
        F.lit("lines").alias("topic"),
        F.col("doc_id").alias("seq"),
        F.lit(None).cast("string").alias("key"),
        F.col("text").alias("value"),
    )


def _room() -> Column:
    number = F.get_json_object("props", "$.k").cast("int") % 10
    return F.concat(F.lit("room-"), number.cast("string"))


def moves(spark: SparkSession, folder: str, streaming: bool = False) -> DataFrame:
    """Events as moves of students into rooms."""
    events = table(spark, folder, "events", streaming).where("event_type <> 'error'")
    return events.select(
        F.lit("student").alias("topic"),
        F.col("event_id").alias("seq"),
        F.col("ts").alias("timestamp"),
        F.col("user_id").cast("string").alias("key"),
        _room().alias("value"),
    )


def capacities(spark: SparkSession, folder: str, streaming: bool = False) -> DataFrame:
    """Error events as capacity settings of rooms."""
    events = table(spark, folder, "events", streaming).where("event_type = 'error'")
    return events.select(
        F.lit("classroom").alias("topic"),
        F.col("event_id").alias("seq"),
        F.col("ts").alias("timestamp"),
        _room().alias("key"),
        F.floor(F.col("user_id") / 5).cast("string").alias("value"),
    )


def partitioned(records: DataFrame) -> DataFrame:
    """A topic's records dealt out to two partitions with offsets of their own, stamped by the hour.

    Offsets repeat between the partitions and between topics, and many records
    share their time, so that only time, topic, partition and offset together order them.
    """
    return records.select(
        "topic",
        (F.col("seq") % 2).cast("int").alias("partition"),
        F.shiftright("seq", 1).alias("seq"),
        F.date_trunc("hour", "timestamp").cast(records.schema["timestamp"].dataType).alias("timestamp"),
        "key",
        "value",
    )
