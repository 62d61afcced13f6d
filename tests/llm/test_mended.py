"""What the operators promise beyond the common case: every step of a search, every copy, every chunk, long words, odd names."""

import itertools
import random
import string
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from logbrook.llm import licenses, packing, quality, simhash, toxicity

FOLDER = "/root/testdata/sf0.001"


# --- packing -----------------------------------------------------------------------------


def raising_step(bins, lengths, capacity):
    """Any move or exchange of one or two for one, or one for two, that raises the squared fills."""
    fills = [sum(lengths[item] for item in own) for own in bins]
    for giver, taker in itertools.permutations(range(len(bins)), 2):
        one, two = ([*itertools.combinations(own, n)] for own, n in ((bins[giver], 1), (bins[giver], 2)))
        back_one, back_two = ([*itertools.combinations(bins[taker], n)] for n in (1, 2))
        steps = [(out, back) for out in one for back in [(), *back_one, *back_two]] + [(out, back) for out in two for back in back_one]
        for out, back in steps:
            moved = sum(lengths[i] for i in out) - sum(lengths[i] for i in back)
            if 0 <= fills[giver] - moved <= capacity and fills[taker] + moved <= capacity:
                if (fills[giver] - moved) ** 2 + (fills[taker] + moved) ** 2 > fills[giver] ** 2 + fills[taker] ** 2:
                    return giver, taker, out, back
    return None


def fewest_bins(lengths, capacity):
    """By trying everything."""
    best = len(lengths)

    def place(at, fills):
        nonlocal best
        if len(fills) >= best:
            return
        if at == len(lengths):
            best = len(fills)
            return
        for number in {fill: number for number, fill in enumerate(fills)}.values():
            if fills[number] + lengths[at] <= capacity:
                fills[number] += lengths[at]
                place(at + 1, fills)
                fills[number] -= lengths[at]
        place(at + 1, [*fills, lengths[at]])

    place(0, [])
    return best


@pytest.mark.parametrize("seed", range(25))
def test_the_search_ends_where_no_step_helps(seed):
    rng = random.Random(seed)
    capacity = rng.choice([20, 50, 100])
    lengths = [rng.randint(1, rng.choice([capacity // 2, capacity])) for _ in range(rng.randint(1, 24))]
    bins = packing.packed_bins(lengths, capacity)
    assert sorted(item for own in bins for item in own) == list(range(len(lengths)))
    assert all(sum(lengths[item] for item in own) <= capacity for own in bins)
    assert len(bins) == -(-sum(lengths) // capacity) or raising_step(bins, lengths, capacity) is None


def test_small_sets_are_packed_as_well_as_can_be():
    rng = random.Random(3)
    found = best = 0
    for _ in range(60):
        lengths = sorted((rng.randint(3, 30) for _ in range(rng.randint(1, 10))), reverse=True)
        found += len(packing.packed_bins(lengths, 40))
        best += fewest_bins(lengths, 40)
    assert best <= found <= best + 1  # over all sixty sets


def test_search_over_hard_lengths_saves_bins():
    rng = random.Random(1)
    lengths = [rng.randint(800, 2000) for _ in range(512)]
    plain = sorted(lengths, reverse=True)
    fills = []
    for length in plain:  # best fit alone
        able = [at for at, fill in enumerate(fills) if fill + length <= 4096]
        if able:
            fills[max(able, key=fills.__getitem__)] += length
        else:
            fills.append(length)
    assert len(packing.packed_bins(lengths, 4096)) <= len(fills) - 5


def test_many_equal_and_tiny_items():
    began = time.time()
    assert len(packing.packed_bins([1] * 9000, 4096)) == 3
    assert len(packing.packed_bins([random.Random(5).randint(1, 90) for _ in range(4000)], 4096)) >= 1
    assert time.time() - began < 60


def test_items_keep_columns_of_any_name(spark):
    rows = [(at, 10 + at % 7, 1, 2, 3, 4, 5) for at in range(40)]
    items = spark.createDataFrame(rows, "doc_id int, length bigint, offset int, Sequence_ID int, _item int, _group int, _open int")
    packed = packing.pack(items, capacity=40)
    assert sorted(packed.columns) == sorted(["doc_id", "length", "_item", "_group", "_open", "sequence_id", "offset"])
    found = packed.collect()
    assert sorted((r["doc_id"], r["length"], r["_item"], r["_group"], r["_open"]) for r in found) == [(r[0], r[1], 3, 4, 5) for r in rows]
    bins = {}
    for row in found:
        bins.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    for own in bins.values():
        place = 0
        for offset, length in sorted(own):
            assert offset == place
            place += length
        assert place <= 40
    assert packing.pack(items.where("false")).collect() == []


# --- quality -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def good_texts(spark):
    """Some long texts that are kept."""
    rows = quality.kept(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("length(text) > 9000")
    return [row["text"] for row in rows.orderBy("doc_id").limit(8).collect()]


def test_noise_in_part_of_a_short_text_is_found(good_texts):
    rng = random.Random(2)
    long = good_texts[0].encode().decode("ascii", "ignore")
    noise = " ".join("".join(rng.choices(string.ascii_letters + string.digits, k=40)) for _ in range(81))
    good, half = long[:7900], long[:4600] + noise[:3300]
    found = quality.judged(pa.array([good, half, noise[:3300] + long[:4600], good[:4096], good[:4097]]))
    assert found["kept"].tolist() == [True, False, False, True, True]
    assert found["chunks"].tolist() == [2, 2, 2, 0, 2]


# --- licenses ----------------------------------------------------------------------------


@pytest.mark.parametrize("times", [1, 2, 3, 40, 500])
@pytest.mark.parametrize("name", ["mit-notice", "cc-by-nc-4.0-notice", "bsd-conditions"])
def test_every_notice_in_a_row_counts(spark, table, name, times):
    if name != "mit-notice" and times > 40:
        pytest.skip("long enough with the short notice")
    text = " ".join([licenses.TEMPLATES[name]] * times)
    rows = [row for row in licenses.found(table([(1, text)])).collect()]
    own = [row for row in rows if name in tuple(row)]
    assert len(own) == times


def full(template, text):
    """The best local alignment without a band: its score."""
    before, best = [0] * (len(text) + 1), 0
    for word in template:
        line = [0]
        for column, other in enumerate(text):
            step = licenses.MATCH if word == other else licenses.MISMATCH
            line.append(max(0, before[column] + step, before[column + 1] + licenses.GAP, line[-1] + licenses.GAP))
        best, before = max(best, *line), line
    return best


def score(template, text, first, last):
    return full(template, text[first : last + 1])


def test_banded_alignment_is_as_good_as_a_full_one_near_its_diagonal():
    rng = random.Random(8)
    for _ in range(200):
        template = [rng.randrange(30) for _ in range(rng.randint(5, 25))]
        copy = [word for word in template if rng.random() > 0.08]
        for _ in range(rng.randint(0, 2)):
            copy.insert(rng.randint(0, len(copy)), 99)
        before = [rng.randrange(100, 200) for _ in range(rng.randint(0, 6))]
        text = np.array(before + copy + [rng.randrange(100, 200) for _ in range(4)])
        first, last, matched = licenses.banded(np.array(template), text, len(before))
        assert first >= 0 and score(template, text.tolist(), first, last) == full(template, text.tolist())


# --- toxicity ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def restorer(spark):
    return toxicity.Restorer(toxicity.character_counts(spark.read.parquet(f"{FOLDER}/documents.parquet"), "text"))


def all_readings(word):
    """Every reading of a word and its price without the characters' own."""
    def after(at):
        if at == len(word):
            yield "", 0.0
            return
        for written, to, price in one_reading(word, at):
            for rest, more in after(to):
                yield written + rest, price + more

    yield from after(0)


def one_reading(word, at):
    mark, readings = word[at], toxicity.READINGS
    yield mark, at + 1, 0.0
    letters = readings.get(mark, "")
    between = at > 0 and word[at - 1].isalpha() and word[at + 1 : at + 2].isalpha()
    if len(letters) < 20 or between:
        for letter in letters:
            yield letter, at + 1, toxicity.SUBSTITUTED + np.log(len(letters))
    run = at
    while run < len(word) and word[run] == mark:
        run += 1
    if run - at >= 3 and (at == 0 or word[at - 1] != mark):
        for letter in [mark] if mark.isalpha() else letters:
            yield letter, run, toxicity.COLLAPSED
            yield 2 * letter, run, toxicity.COLLAPSED
    skipped = at < 2 or word[at - 2] in toxicity.BETWEEN or word[at + 2 : at + 3] in toxicity.BETWEEN
    if mark in toxicity.BETWEEN and 0 < at < len(word) - 1 and skipped:
        yield "", at + 1, toxicity.SKIPPED


def price_of(restorer, text):
    kinds = [toxicity.BLANK, toxicity.BLANK, *(int(toxicity.CLASS_OF[min(ord(m), len(toxicity.CLASS_OF) - 1)]) for m in text), toxicity.BLANK]
    return sum(float(restorer.price[a, b, c]) for a, b, c in zip(kinds, kinds[1:], kinds[2:]))


def test_restored_is_the_cheapest_of_all_readings(restorer):
    rng = random.Random(6)
    words = ["h3ll0", "aaaa", "baaad", "***a", "a***b", "s-t-o-p", "$$$h1t", "oooo0", "w.o.r.d", "a*b", "111", "eeeeeeee", "^^^^^x"]
    words += ["".join(rng.choice("aest013$*.-") for _ in range(rng.randint(1, 6))) for _ in range(150)]
    for word in words:
        best = min(price + price_of(restorer, text) for text, price in all_readings(word))
        own = restorer.restored(word)
        reached = min(price + price_of(restorer, text) for text, price in all_readings(word) if text == own)
        assert reached == pytest.approx(best), word


def test_long_words_take_time_in_proportion(restorer):
    began = time.time()
    restorer.restored("a" * 1_000_000)
    assert time.time() - began < 5
    began = time.time()
    restorer.restored("no" + "o" * 1_000_000 + "way")
    assert time.time() - began < 5
    took = []
    for n in (20_000, 80_000):
        began = time.time()
        restorer.restored("ab" * n + "0" * n)
        took.append(time.time() - began)
    assert took[1] < 12 * took[0] + 1


# --- one of each -------------------------------------------------------------------------


@pytest.mark.parametrize("parts", [1, 2, 7])
def test_rows_that_share_an_id(spark, parts):
    first, other = "one text about rivers and stones " * 9, "quite another text on letters and windows " * 9
    rows = [(1, first, 7, "x"), (1, other, 8, "x"), (1, other, 8, "x"), (1, other, 9, "x"), (2, first + "end", 1, None), (None, None, 1, None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, first_id int, row string").repartition(parts)
    found = simhash.one_of_each(frame)
    assert found.columns == frame.columns
    kept = sorted(map(tuple, found.collect()), key=str)
    assert len(kept) == len([row for row in kept if row[0] is None]) + len({row[0] for row in kept if row[0] is not None})
    again = sorted(map(tuple, simhash.one_of_each(frame.repartition(3, "first_id")).collect()), key=str)
    assert kept == again


def test_null_and_empty_tables_go_through_the_pipeline(spark, tmp_path, good_texts):
    import corpus_pipeline

    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, first_id int, offset int, _item int"
    labels = "doc_id bigint, quality int, toxic int"
    odd = [(None, None, None, None, None, 1, 2, 3), (51, "", "en", "s", 0, 1, 2, 3), (52, "short", "en", "s", 5, 1, 2, 3), (52, "short", "en", "s", 5, 1, 2, 3)]
    odd += [(at, good_texts[at], "en", "s", 2000, 1, 2, 3) for at in range(4)]
    for name, rows in (("empty", []), ("odd", odd)):
        folder = str(tmp_path / name)
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(1, 1, 0)][: len(rows)], labels).write.parquet(f"{folder}/labels.parquet")
        found = corpus_pipeline.run(spark, folder)
        assert {"doc_id", "sequence_id", "offset"} <= set(found.columns)
        assert {row["doc_id"] for row in found.collect()} == ({0, 1, 2, 3} if rows else set())
