"""Topics as tables: append-only logs of (key, value) records.

A record is ``topic, partition, seq, timestamp, key, value``; ``seq`` is the
log offset and gives the order. Topics live either behind a broker connector
or in a folder of parquet files. The broker's format name and connection
options are the caller's, as the connector is a separate Spark package.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logbrook.functions import long_from_wire, long_to_wire

# What one micro-batch may take in, and with it what one key may have in it.
FILE_LIMIT = {"maxBytesPerTrigger": str(1 << 30)}
BROKER_LIMIT = {"maxOffsetsPerTrigger": str(20_000_000)}

RECORD = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("seq", T.LongType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)


def from_broker(raw: DataFrame, value: str = "string") -> DataFrame:
    """Decode a connector's binary rows; ``value`` is ``string`` or ``bigint``.

    Times become what topic folders hold, times of UTC without a zone, whatever the session's zone.
    """
    time = F.expr("timestampadd(MICROSECOND, unix_micros(timestamp), TIMESTAMP_NTZ'1970-01-01 00:00:00')")
    body = long_from_wire(F.col("value")) if value == "bigint" else F.col("value").cast("string")
    return raw.select(
        "topic",
        "partition",
        F.col("offset").alias("seq"),
        time.alias("timestamp"),
        F.col("key").cast("string").alias("key"),
        body.alias("value"),
    )


def _from_the_start(options: dict[str, str], topic: str) -> dict[str, str]:
    return {"subscribe": topic, "startingOffsets": "earliest", **options}


def stream_broker(spark: SparkSession, fmt: str, topic: str, options: dict[str, str], value: str = "string") -> DataFrame:
    """Follow a topic from its beginning."""
    options = _from_the_start({**BROKER_LIMIT, **options}, topic)
    return from_broker(spark.readStream.format(fmt).options(**options).load(), value)


def read_broker(spark: SparkSession, fmt: str, topic: str, options: dict[str, str], value: str = "string") -> DataFrame:
    """Replay a topic from its beginning up to now."""
    return from_broker(spark.read.format(fmt).options(**_from_the_start(options, topic)).load(), value)


def to_broker(records: DataFrame, key: str = "key", value: str = "value") -> DataFrame:
    """The two columns a connector's sink takes; a bigint becomes its wire form, anything else text."""
    number = records.schema[value].dataType == T.LongType()
    body = long_to_wire(F.col(value)) if number else F.col(value).cast("string")
    return records.select(F.col(key).cast("string").alias("key"), body.alias("value"))


def write_broker(records: DataFrame, fmt: str, topic: str, options: dict[str, str], key: str, value: str) -> None:
    """Append a batch of records to a topic."""
    to_broker(records, key, value).write.format(fmt).options(topic=topic, **options).mode("append").save()


def stream_topic(
    spark: SparkSession, path: str, schema: T.StructType | str = RECORD, limit: dict | None = None
) -> DataFrame:
    """Follow a topic folder; ``limit`` is the option that bounds a micro-batch."""
    return spark.readStream.schema(schema).options(**(limit or FILE_LIMIT)).parquet(path)


def read_topic(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Replay a topic folder."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_topic(records: DataFrame, path: str) -> str:
    """Append records to a topic folder."""
    records.write.mode("append").parquet(path)
    return path


def write_topic_files(records: DataFrame, path: str, files: int) -> str:
    """Write records to a new topic folder as exactly so many files, dealt out in turn; with fewer records some are empty."""
    write_topic(records.repartition(files), path)
    written = len(read_topic(records.sparkSession, path, records.schema).inputFiles())
    for _ in range(files - written):
        write_topic(records.limit(0).coalesce(1), path)
    return path


def close_topic(spark: SparkSession, path: str, seq: int) -> str:
    """Append an empty record at ``seq``: the topic has nothing more before it."""
    record = spark.createDataFrame([(seq, None, None)], "seq bigint, key string, value string")
    return write_topic(record.coalesce(1), path)
