"""Collocations against counting everything in plain Python, and against SQL."""

import collections
import re

import duckdb
import numpy as np
import pytest

from logbrook.llm import collocations, queries

FOLDER = "/root/testdata/sf0.01"


def brute_counts(rows):
    counts, totals = collections.defaultdict(collections.Counter), collections.Counter()
    for text, lang in rows:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for size in range(1, 5):
                for at in range(len(words) - size + 1):
                    counts[lang or "und"][tuple(words[at : at + size])] += 1
    return counts, totals


def brute(rows, support, most):
    counts, totals = brute_counts(rows)
    found = []
    for lang, own in counts.items():
        kept = []
        for phrase, a in own.items():
            if len(phrase) < 2 or a < support:
                continue
            cuts = [(2_000_000 * a // (own[phrase[:k]] + own[phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            longer = [other for other, n in own.items() if len(other) > len(phrase) and n >= support and 100 * n >= 80 * a]
            if any(other[at : at + len(phrase)] == phrase for other in longer for at in range(len(other) - len(phrase) + 1)):
                continue
            kept.append((-score, -a, " ".join(phrase).encode(), own[phrase[:k]], own[phrase[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(kept)[:most], 1):
            found.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(found)


def made_rows(rng):
    words = ["alpha", "Beta", "gamma", "é", "日本", "delta x", "#", "a|b", "New", "York"]
    texts = [" ".join(rng.choice(words[: rng.choice([3, 6, 10])]) + rng.choice(["", "", "", ",", ".\n", "!", "\t", "\x0b"]) for _ in range(rng.randint(1, 60))) for _ in range(150)]
    texts += ["new york city hall", "in New York City"] * 8 + [None, "", "  ", "...", "a" * 3000, "b " * 3000]
    langs = ["en", "fr", None, "en", "en"]
    return list(enumerate(texts)) + [(3, "york city"), (3, "york city"), (None, "york city"), (None, None)], langs


@pytest.mark.parametrize("one_in, support", [(1, 4), (3, 4), (8, 4), (1000, 4), (2, 1)])
def test_equals_brute_force_whatever_the_sample(table, rng, one_in, support):
    rows, langs = made_rows(rng)
    documents = table(rows, langs)
    found = collocations.ranked(documents, support=support, most=40, sample_one_in=one_in)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    own = [(text, langs[at % len(langs)]) for at, (_, text) in enumerate(rows)]
    assert sorted(map(tuple, found.collect())) == brute(own, support, 40)


def test_all_frequent_phrases_are_counted_exactly(table, rng):
    rows, langs = made_rows(rng)
    phrases, totals, passes = collocations.frequent(table(rows, langs), support=4, sample_one_in=1000)
    counts, all_words = brute_counts([(text, langs[at % len(langs)]) for at, (_, text) in enumerate(rows)])
    expected = {(lang, len(p), " ".join(p), n) for lang, own in counts.items() for p, n in own.items() if n >= 4}
    assert sorted(map(tuple, phrases.collect())) == sorted(expected)
    assert dict(map(tuple, totals.collect())) == {lang: n for lang, n in all_words.items() if n}
    assert passes > 1  # an empty sample proposes nothing, so the border must fail
    assert collocations.frequent(table(rows, langs), support=4, sample_one_in=1)[2] == 1


def test_a_crowded_sieve_loses_nothing(table, rng):
    """Where all bits are set all phrases are let in, which costs counting only."""
    rows, langs = made_rows(rng)
    full = collocations.Sieve({size: [np.full(1 << 12, 255, np.uint8)] for size in (1, 2, 3)})
    found = collocations.counts(table(rows, langs), "text", "lang", full, None, (1, 2, 3, 4)).where("size > 0")
    counts, _ = brute_counts([(text, langs[at % len(langs)]) for at, (_, text) in enumerate(rows)])
    expected = [(lang, len(p), " ".join(p), n) for lang, own in counts.items() for p, n in own.items()]
    assert sorted(map(tuple, found.collect())) == sorted(expected)
    none = collocations.Sieve({})
    later = collocations.counts(table(rows, langs), "text", "lang", full, none, (2, 3, 4))
    assert sorted(map(tuple, later.collect())) == sorted(row for row in expected if row[1] > 1)
    assert collocations.counts(table(rows, langs), "text", "lang", full, full, (2, 3, 4)).collect() == []
    small = collocations.frequent(table(rows, langs), support=4, most_bits=15)[0]
    assert sorted(map(tuple, small.collect())) == sorted(row for row in expected if row[3] >= 4)


def test_nothing_in_nothing_out(nothing_here, table):
    assert collocations.ranked(nothing_here).collect() == []
    assert collocations.ranked(table([(1, None), (2, "")])).collect() == []


def test_products_beyond_64_bits(spark):
    """a up to 10**15 times 2,000,000, and times 100 and 80."""
    big = 10**15
    rows = [("en", 1, "x", 3 * big), ("en", 1, "y", 2 * big), ("en", 1, "z", 2 * big), ("en", 2, "x y", big + 1), ("en", 2, "y z", big), ("en", 3, "x y z", 8 * big // 10)]
    phrases = spark.createDataFrame(rows, "grp string, size int, phrase string, n bigint")
    scored = {row["phrase"]: row["score"] for row in collocations._scored(phrases).collect()}
    assert scored["x y"] == 2_000_000 * (big + 1) // (5 * big) and scored["y z"] == 500_000
    left = collocations._free(collocations._scored(phrases), phrases)
    assert sorted(row["phrase"] for row in left.collect()) == ["x y", "x y z"]


def test_query_equals_sql(spark):
    found = queries.queries()["op11_collocations"](spark, FOLDER)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    expected = duck.execute(queries.oracle_sql()["op11_collocations"])
    assert found.columns == [column[0] for column in expected.description]
    rows = sorted(map(tuple, found.collect()))
    assert rows and rows == sorted(expected.fetchall())
