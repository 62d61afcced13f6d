"""Personal data: plain identifiers against plain patterns, disguises against what they hide."""

import hashlib
import re
import time

import pyarrow as pa
import pytest

from logbrook.llm import personal, queries

PATTERNS = [
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def luhn(digits):
    total = 0
    for at, digit in enumerate(reversed(digits)):
        digit = 2 * digit if at % 2 else digit
        total += digit - 9 if digit > 9 else digit
    return total % 10 == 0


def holds(kind, match):
    digits = [int(mark) for mark in match if mark in "0123456789"]
    if kind == 1:
        return all(int(part) <= 255 for part in match.split("."))
    if kind == 2:
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == 0 or 8 <= len(digits) <= 15


def brute(text):
    return [(kind, *m.span()) for kind, pattern in enumerate(PATTERNS) for m in pattern.finditer(text or "") if holds(kind, m[0])]


def shown(spans):
    return ",".join(f"{personal.KINDS[kind]}:{start}:{end}" for kind, start, end in spans)


def test_base_equals_plain_patterns(rng):
    for marks in ("a@.1+ 2-(5", "a@b.-%", "0123456789. -+", "é@.1日", "4 1-1"):
        for _ in range(6000):
            text = "".join(rng.choice(marks) for _ in range(rng.randint(0, 45)))
            assert personal.plain(text) == brute(text), text


HIDDEN = [
    ("email", "write to ", "john.doe at example dot com", " now"),
    ("email", "write to ", "john dot doe [at] mail (dot) example [dot] org", ", thanks"),
    ("email", "(", "alice (at) example.com", "!"),
    ("email", "", "аlice@exаmple.com", ""),
    ("email", "x ", "bo​b@ex­ample.com", " y"),
    ("email", "", "bob@mail(dot)example(dot)com", ""),
    ("email", "", "name_at_host_dot_org", " "),
    ("email", "", "user&#64;site&#46;net", ""),
    ("email", "", "ｂｏｂ＠ｅｘａｍｐｌｅ．ｃｏｍ", ""),
    ("email", "é ", "maria arroba correo punto es", ""),
    ("email", "", "bob @ example.com", ""),
    ("ip", "host ", "192[.]168[.]1[.]1", ""),
    ("ip", "", "one nine two dot one six eight dot zero dot one", ""),
    ("ip", "", "10 dot 0 dot 0 dot 1", ""),
    ("card", "card ", "４１１１ １１１１ １１１１ １１１１", " ok"),
    ("card", "", "four " + "one " * 14 + "one", ""),
    ("card", "", "411l 1111 11O2 1111".replace("O2", "11"), ""),
    ("phone", "call ", "plus four nine one seven zero five five five one two", ""),
    ("phone", "call ", "plus four nine, double five one two three four", " now"),
    ("phone", "", "+٤٩ 170 555 1234", ""),
]


@pytest.mark.parametrize("kind, before, hidden, behind", HIDDEN)
def test_disguises_are_mapped_back(kind, before, hidden, behind):
    text = before + hidden + behind
    base, added = personal.Finder().spans(text)
    assert base == brute(text)
    assert [(personal.KINDS[k], text[start:end]) for k, start, end in added] == [(kind, hidden)]
    assert list(personal.Finder().all_spans(pa.array([text]))) == [(base, added)]  # the hints let it through


@pytest.mark.parametrize(
    "text",
    ["look at the dot com boom", "at some point in time", "meet me at noon. one two three four", "look at example.com", "a@b", "", "he came at 5 dot 30",
     "one, two, three, four, five, six, seven, eight", "mail me at home [at last]", "um vier Uhr am Punkt drei", "le point de vue (at) de", "5 l 3"],
)
def test_plain_language_is_left_alone(text):
    assert personal.Finder().spans(text) == ([], [])


def test_base_spans_stay_beside_added_ones():
    text = "bob@mail.example.com and eve at mail dot example dot com and 1.2.3.4"
    base, added = personal.Finder().spans(text)
    assert base == brute(text) and [text[s:e] for _, s, e in added] == ["eve at mail dot example dot com"]


@pytest.mark.parametrize("step", ["a", "1", "1.", "@", "one ", "a@", "(at)", " dot ", "a at b dot ", "+1(", "dot-", "[ ", "1 ", "а"])
def test_long_texts_take_time_in_proportion(step):
    began = time.time()
    personal.Finder().spans(step * (400_000 // len(step)))
    assert time.time() - began < 20


def test_rewriting_maps_every_place(rng):
    for _ in range(500):
        old = "".join(rng.choice("abcd") for _ in range(rng.randint(1, 20)))
        cuts = sorted(rng.sample(range(len(old) + 1), min(len(old) + 1, 2 * rng.randint(0, 4))))
        edits = [(a, b, rng.choice(["", "X", "XYZ"])) for a, b in zip(cuts[::2], cuts[1::2])]
        step = personal.Rewritten(old, edits)
        source = []  # of every new character: the old span it came from
        last = 0
        for a, b, written in edits:
            source += [(at, at + 1) for at in range(last, a)] + [(a, b)] * len(written)
            last = b
        source += [(at, at + 1) for at in range(last, len(old))]
        assert len(step.text) == len(source)
        for start in range(len(source)):
            for end in range(start + 1, len(source) + 1):
                assert step.source(start, end) == (source[start][0], source[end - 1][1])
                low, high = step.source(start, end)
                assert step.touched(start, end) == (any(a < high and low < b for a, b, _ in edits))


def test_documents_with_odd_rows(spark, table, nothing_here, rng):
    texts = [None, "", "  ", "x" * 200_000 + "@a.b", *(before + hidden + behind for _, before, hidden, behind in HIDDEN)]
    rows = [*enumerate(texts), (3, "a@b.cd"), (3, "a@b.cd"), (None, "1.2.3.4"), (None, None)]
    finder = personal.Finder()

    def expected(key, text):
        base, added = finder.spans(text or "")
        counts = [sum(k == kind for k, _, _ in base) for kind in range(4)]
        return (key, *counts, hashlib.sha256(shown(brute(text)).encode()).hexdigest(), shown(sorted(base + added)), len(added))

    found = personal.found(table(rows))
    assert sorted(map(tuple, found.collect()), key=str) == sorted((expected(*row) for row in rows), key=str)
    assert personal.found(nothing_here).collect() == []
    masked = personal.masked(table(rows))
    assert masked.columns == table(rows).columns
    left = [row["text"] for row in masked.collect()]
    assert sum(text is None for text in left) == 2
    assert all(finder.spans(text) == ([], []) for text in left if text)
    assert personal.masked(nothing_here).collect() == []


def test_query_on_whole_documents(spark):
    found = queries.queries()["op12_personal"](spark, "/root/testdata/sf0.01").collect()
    texts = dict(map(tuple, spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()))
    assert len(found) == len(texts)
    for row in found:
        base = brute(texts[row["doc_id"]])
        assert [row[f"n_{kind}"] for kind in personal.KINDS] == [sum(k == at for k, _, _ in base) for at in range(4)]
        assert row["base_sha256"] == hashlib.sha256(shown(base).encode()).hexdigest()
        assert row["spans"] == shown(base)  # nothing is disguised in these texts
