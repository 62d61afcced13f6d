import random

import pytest

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, grp string, size int, phrase string, n int, rank int, score int,"
    " start int, length int, period int, spans string, kind string, a int, l int, r int"
)


def odd_rows(texts, lang=None):
    extra = ("src", "g", 1, "p", 2, 3, 4, 5, 6, 7, "s", "k", 8, 9, 10)
    return [(number, text, lang[at % len(lang)] if lang else "en", *extra) for at, (number, text) in enumerate(texts)]


@pytest.fixture(scope="session")
def table(spark):
    """Makes a table of (doc_id, text) rows with many further columns, some named like those of results."""

    def make(texts, lang=None):
        return spark.createDataFrame(odd_rows(texts, lang), SCHEMA).repartition(3)

    return make


@pytest.fixture(scope="session")
def nothing_here(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def rng():
    return random.Random(11)
