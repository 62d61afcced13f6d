"""Word count as a batch, over lines with a ``value`` and, where words keep their place, a ``seq``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logbrook.functions import long_to_wire
from logbrook.operators import heavy_keys, rekeyed, running_state, word_counts, word_records
from logbrook.sources import spread

LINE_BLOCK_BITS = 12
"""Lines hold many words each, so their blocks span fewer offsets."""


def word_tokens(lines: DataFrame, partitions: int | None = None) -> DataFrame:
    """``seq, pos, word``. With ``partitions``, the lines are dealt out to so many tasks first."""
    return word_records(spread(lines.select("seq", "value"), partitions, "seq"), "seq")


def word_rekey(lines: DataFrame, partitions: int | None = None) -> DataFrame:
    """The words as records keyed by themselves."""
    return rekeyed(word_tokens(lines, partitions), "seq", "pos")


def word_count(lines: DataFrame, partitions: int | None = None) -> DataFrame:
    """``word, n``."""
    return word_counts(spread(lines.select("value"), partitions))


def word_count_wire(lines: DataFrame, partitions: int | None = None) -> DataFrame:
    """The counts as the output topic holds them: word, and eight bytes."""
    return word_count(lines, partitions).select(F.col("word").alias("key"), long_to_wire(F.col("n")).alias("value"))


def word_count_changelog(
    lines: DataFrame, bits: int = LINE_BLOCK_BITS, partitions: int | None = None, heavy: Sequence[str] | None = None
) -> DataFrame:
    """The count of a word after each of its occurrences: ``seq, pos, word, n``.

    ``heavy`` words, those in more lines than a block has, are found first in one line of 64 if they are not given.
    """
    words = word_tokens(lines, partitions)
    if heavy is None:
        sample = word_tokens(lines.sample(1 / 64, seed=1))
        (heavy,) = heavy_keys(sample, ("word", (1 << bits) // 64), one_in=1)
    counted = running_state(words, "word", ["seq", "pos"], sums={"n": F.lit(1)}, bits=bits, heavy=heavy)
    return counted.select("seq", "pos", "word", "n")
