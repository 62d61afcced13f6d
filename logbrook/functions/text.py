"""Tokenising."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def words(line: Column) -> Column:
    r"""The lower-cased words of a line as an array, cut at runs of ``\W``.

    Follows Java's ``String.split``: a line that opens with a separator yields
    a leading empty word, trailing empty words vanish, and the empty line is one
    empty word. Spark's own ``split`` keeps the trailing ones, so the words are
    extracted instead. A null line has no words.
    """
    lowered = F.lower(line)
    empty_word = F.array(F.lit(""))
    leading = F.when(lowered.rlike(r"\A\W+\w"), empty_word).otherwise(F.array().cast("array<string>"))
    found = F.regexp_extract_all(lowered, F.lit(r"\w+"), F.lit(0))
    return F.when(line == "", empty_word).otherwise(F.concat(leading, found))
