import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logbrook import fixtures
from logbrook.functions import words
from logbrook.plans import word_count

# Lines and their words.
LINES = [
    ("", [""]),
    ("!!!", []),
    ("  ", []),
    ("É", []),
    (" a b", ["", "a", "b"]),
    ("a b ", ["a", "b"]),
    ("Hello, world", ["hello", "world"]),
    ("a!\n", ["a"]),
    ("iechä x", ["iech", "x"]),
    ("a_b-c", ["a_b", "c"]),
    ("don't", ["don", "t"]),
    ("İx", ["i", "x"]),
    ("K", ["k"]),
    (None, None),
]


def split(spark, lines):
    frame = spark.createDataFrame(list(enumerate(lines)), "i int, line string")
    return [row.words for row in frame.select("i", words(F.col("line")).alias("words")).orderBy("i").collect()]


def test_golden_lines(spark):
    assert split(spark, [line for line, _ in LINES]) == [found for _, found in LINES]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(lines=st.lists(st.text(alphabet="aB9_ -!\nÉßž", max_size=12), min_size=1, max_size=40))
def test_words_follow_java_split(spark, lines):
    pattern = spark._jvm.java.util.regex.Pattern.compile(r"\W+")
    assert split(spark, lines) == [list(pattern.split(line.lower())) for line in lines]


@pytest.fixture(scope="module")
def lines(spark):
    return fixtures.text_lines(spark, "/root/testdata/sf0.001")


def test_counts_add_up_to_tokens(lines):
    assert word_count.word_count(lines).agg({"n": "sum"}).first()[0] == word_count.word_tokens(lines).count()


@pytest.mark.parametrize("bits", [2, 5])
def test_changelog_ends_at_the_count_at_any_block_size(lines, bits):
    log = word_count.word_count_changelog(lines, bits)
    last = log.groupBy("word").agg(F.max("n").alias("n"))
    steps = log.groupBy("word").agg(F.countDistinct("n").alias("n"))
    counts = word_count.word_count(lines)
    for other in (last, steps):
        assert counts.exceptAll(other).isEmpty() and other.exceptAll(counts).isEmpty()
    assert log.exceptAll(word_count.word_count_changelog(lines)).isEmpty()
    assert len(re.findall("ReusedExchange", _final_plan(log))) == 1


def _final_plan(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
