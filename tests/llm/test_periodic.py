"""Periodic runs against a search over all periods."""

import hashlib
import re
import time

import numpy as np
import pyarrow as pa

from logbrook.llm import periodic, queries
from logbrook.llm.batches import Words


def brute(words):
    n, found = len(words), set()
    for period in range(1, n // 4 + 1):
        at = 0
        while at + period < n:
            end = at
            while end + period < n and words[end] == words[end + period]:
                end += 1
            length = end - at + period
            root = words[at : at + period]
            smallest = not any(period % d == 0 and root == root[:d] * (period // d) for d in range(1, period))
            if length >= max(6, 4 * period) and end > at and smallest:
                found.add((at, length, period))
            at = end + 1
    return sorted(found)


def shuffled_runs(rng, count):
    for _ in range(count):
        letters = rng.choice([1, 2, 3, 5, 50])
        words = [rng.randrange(letters) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            root = [rng.randrange(letters) for _ in range(rng.randint(1, 6))]
            at = rng.randint(0, len(words))
            words[at:at] = (root * 9)[: rng.randint(4, 40)]
        yield words


def numbered(texts):
    text = np.repeat(np.arange(len(texts)), [len(words) for words in texts])
    return text, np.array([word for words in texts for word in words], np.int64)


def test_runs_equal_brute_force(rng):
    texts = list(shuffled_runs(rng, 1500))
    assert periodic.runs(*numbered(texts), len(texts)) == [brute(words) for words in texts]


def test_grammar_is_closed_and_derives_the_text(rng):
    for words in shuffled_runs(rng, 200):
        if len(words) < 6:
            continue
        text, code = numbered([words])
        pairs = {pair: at for _, pair, at in periodic._pairs(text, code)}
        grammar = periodic.Grammar(words, pairs, 1000)
        # Every nonterminal derives the same words at all its places, and is used at least twice.
        for places, parts in zip(grammar.places, grammar.parts):
            assert len(places) > 1 and len({tuple(words[at : at + sum(parts)]) for at in places}) == 1
        ends = [*grammar.top[1:], len(words)]
        shown = [tuple(words[a:b]) for a, b in zip(grammar.top, ends)]
        pairs = list(zip(shown, shown[1:]))
        again = [pair for at, pair in enumerate(pairs) if pair in pairs[at + 2 :]]
        assert not again


def test_long_texts_take_time_in_proportion():
    began = time.time()
    n = 300_000
    same = np.zeros(n, np.int64)
    assert periodic.runs(same, same, 1) == [[(0, n, 1)]]
    assert periodic.runs(same, np.arange(n) % (n // 5), 1) == [[(0, n, n // 5)]]
    assert periodic.runs(same, np.arange(n), 1) == [[]]
    assert time.time() - began < 60


def expected(key, text, reread):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if reread and key is not None:
        order = reread(key, len(words))
        words = words if order is None else [words[at] for at in order]
    runs = brute(words)
    dropped = {at for start, length, period in runs for at in range(start + period, start + length)}
    kept = " ".join(word for at, word in enumerate(words) if at not in dropped)
    longest = max(runs, key=lambda run: (run[1], -run[0], -run[2]), default=None)
    shown = (*longest, 1000 * longest[1] // longest[2]) if longest else (None,) * 4
    listed = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    return (key, len(runs), *shown, *(hashlib.sha256(value.encode()).hexdigest() for value in (listed, kept)))


def test_documents_with_odd_rows(spark, table, nothing_here, rng):
    texts = [None, "", "  \n", "a", "la " * 400, "é b é b é b é b", "a b\ta\nb a b a\x0bb a"]
    texts += [" ".join(map(str, words)) for words in shuffled_runs(rng, 80)]
    rows = [*enumerate(texts), (7, "x x x x x x"), (7, "x x x x x x"), (None, "y z " * 9), (None, None)]
    for reread in (None, queries.looped):
        found = sorted(map(tuple, periodic.found(table(rows), reread=reread).collect()), key=str)
        assert found == sorted((expected(*row, reread) for row in rows), key=str)
    assert periodic.found(nothing_here).collect() == []


def test_loops_of_the_query():
    words = [str(at) for at in range(100)]
    key = next(key for key in range(200) if queries.looped(key, 100) is not None)
    code = __import__("zlib").crc32(str(key).encode())
    start = code // 10 % 100
    period = 1 + (100 - start) // (3 + code // 10 % 8)
    read = [words[at] for at in queries.looped(key, 100)]
    assert read[:start] == words[:start]
    assert all(read[at] == words[start + (at - start) % period] for at in range(start, 100))


def test_query_on_whole_documents(spark):
    found = {row["doc_id"]: tuple(row) for row in queries.queries()["op13_periodic"](spark, "/root/testdata/sf0.001").collect()}
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(rows)
    short = [row for row in rows if len((row["text"] or "").split()) < 400]
    assert all(found[row["doc_id"]] == expected(row["doc_id"], row["text"], queries.looped) for row in short)
    assert any(found[row["doc_id"]][1] for row in short)


def test_words_of_a_batch_are_told_apart():
    words = Words(pa.array(["a a a", "a a a"]))
    assert periodic.runs(words.text, words.code, 2) == [[], []]
