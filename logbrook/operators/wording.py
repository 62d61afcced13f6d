"""Words out of text lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logbrook.functions import words


def word_records(lines: DataFrame, *keep: str, text: str = "value") -> DataFrame:
    """One record per word of each line, under the line's key; ``pos`` counts from 0."""
    return lines.select(*keep, F.posexplode(words(F.col(text))).alias("pos", "word"))


def rekeyed(records: DataFrame, *keep: str, value: str = "word") -> DataFrame:
    """Records keyed by their own value."""
    return records.select(*keep, F.col(value).alias("key"), F.col(value).alias("value"))


def word_counts(lines: DataFrame, text: str = "value") -> DataFrame:
    """How often each word occurs. Works on batch and streaming lines alike."""
    return lines.select(F.explode(words(F.col(text))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
