"""Text lines in, text lines out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logbrook.sources.topics import FILE_LIMIT


# For true copies: a carriage return belongs to its line. Otherwise it ends one, alone or before a line feed.
VERBATIM = {"lineSep": "\n"}


def read_lines(spark: SparkSession, path: str, verbatim: bool = False) -> DataFrame:
    """Plain text lines as records without a key."""
    return _keyless(spark.read.options(**(VERBATIM if verbatim else {})).text(path))


def stream_lines(spark: SparkSession, path: str, limit: dict | None = None, verbatim: bool = False) -> DataFrame:
    """The same, following a folder; ``limit`` is the option that bounds a micro-batch."""
    options = (VERBATIM if verbatim else {}) | (limit or FILE_LIMIT)
    return _keyless(spark.readStream.options(**options).text(path))


def _keyless(lines: DataFrame) -> DataFrame:
    return lines.select(F.lit(None).cast("string").alias("key"), "value")


def parse_keyed_lines(lines: DataFrame, line: str = "line", separator: str = ",") -> DataFrame:
    """``key,value`` lines as ``key`` and ``value``, with a ``rejected`` flag.

    The first separator cuts; later ones belong to the value. A line without
    one is kept in ``value``, flagged and without a key.
    """
    at = F.instr(line, separator)
    whole = F.col(line)
    return lines.select(
        *[name for name in lines.columns if name != line],
        F.when(at > 0, F.substring(whole, F.lit(1), at - 1)).alias("key"),
        F.when(at > 0, F.substring(whole, at + len(separator), F.length(whole))).otherwise(whole).alias("value"),
        (at == 0).alias("rejected"),
    )


def printed(key: Column, value: Column, separator: str = ",") -> Column:
    """A record the way a console shows it; ``null`` stands for a missing part."""
    return F.concat_ws(separator, *[F.coalesce(part.cast("string"), F.lit("null")) for part in (key, value)])
