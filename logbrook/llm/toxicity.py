"""Toxicity of texts whose words may be disguised: a noisy channel undone, then scored.

Three things make a model. A character trigram model counted over all documents
says what the writer may have meant. A lattice per suspicious word holds its
readings: marks read as letters, runs of a letter as one or two, blanks and stops
between single letters as nothing; the Viterbi path through it, at the price of each reading under
the character model, restores the word. Words without such marks have one
reading and are taken as they are. The evidence of restored words and of their beginnings is learned
from labelled documents, and a logistic curve turns a text's evidence into a
score.

Labels are learned from a bounded sample (``SAMPLE`` rows of each class, those
with the smallest hash); half of it is for the evidence, half for the curve. All
evidence found there is kept, which the sample bounds. The character model has
``len(CLASSES)**3`` counts however long the corpus is. These bounds make the model
small enough to be sent to every task.

Defined results: null and empty texts have no evidence and get the curve's
lowest score. Without labels of both kinds every score is 0. Rows without an id,
repeated rows and extra columns make no difference; of contradicting labels of
one document the toxic one counts.
"""

from __future__ import annotations

import math
import re
import string
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logbrook.llm.batches import Words, filled, map_texts, stored

SAMPLE = 8_000
FOLDS, HELD_OUT = 5, 0

# The marks and the letters they may stand for.
READINGS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "{": "c", "€": "e", "£": "l", "¡": "i",
    "*": string.ascii_lowercase, "#": "h", "%": "x", "&": "a",
}
BETWEEN = " .-_*~'`,/|+"
EDGES = string.punctuation + "¡¿«»“”„’‘…"
THRICE = re.compile(r"(.)\1\1")
DECORATION = re.compile(r"^[.,;:?'\"\-]+|[.,;:?'\"\-]+$|([^\w\s])\1+")
SUBSTITUTED, COLLAPSED, SKIPPED = 1.5, 1.0, 0.5
"""Prices of readings, in nats."""

SPACED = 4
"""So many single characters in a row are suspicious."""

# Classes of characters: a to z each, other letters, digits, other marks, blanks.
CLASSES = [*string.ascii_lowercase, "letter", "digit", "mark", "blank"]
BLANK = len(CLASSES) - 1
SLICE = 1 << 20
PREFIXES = (6, 5, 4)
SHINGLE = 5
LEAST_DOCUMENTS = 3
CAUTION = 2.0
"""Standard deviations taken off a log-odds before it counts."""


def _class_table() -> np.ndarray:
    table = np.full(1 << 16, CLASSES.index("mark"), np.int64)
    for code in range(1 << 16):
        mark = chr(code)
        if mark.isalpha():
            table[code] = CLASSES.index("letter")
        elif mark.isdigit():
            table[code] = CLASSES.index("digit")
        elif mark.isspace():
            table[code] = BLANK
    for letter in string.ascii_lowercase:
        table[ord(letter)] = CLASSES.index(letter)
    return table


CLASS_OF = _class_table()


# --- the character model -----------------------------------------------------------------


def character_counts(documents: DataFrame, text: str = "text") -> np.ndarray:
    """How often each three classes follow one another, over all documents."""
    n = len(CLASSES)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n**3, np.int64)
        for batch in batches:
            for joined in _joined(filled(batch.column(0)).to_pylist()):
                codes = np.frombuffer(joined.lower().encode("utf-32-le"), np.uint32)
                kinds = CLASS_OF[np.minimum(codes, len(CLASS_OF) - 1)]
                kinds = kinds[np.append(True, (kinds[1:] != BLANK) | (kinds[:-1] != BLANK))]
                total += np.bincount((kinds[:-2] * n + kinds[1:-1]) * n + kinds[2:], minlength=n**3)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["gram", "n"])

    rows = documents.select(text).mapInArrow(count, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    counts = np.zeros(n**3)
    for gram, times in rows.collect():  # at most n**3 rows
        counts[gram] = times
    return counts.reshape(n, n, n)


def _joined(texts: list[str]) -> Iterator[str]:
    """Texts with blanks between and around, some ``SLICE`` characters at a time."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= SLICE:
            yield f" {' '.join(held)} "
            held, size = [], 0
    yield f" {' '.join(held)} "


class Restorer:
    """Reads disguised words."""

    def __init__(self, counts: np.ndarray) -> None:
        smoothed = counts + 0.5
        pairs = smoothed.sum(axis=0) + 1.0
        follow = pairs / pairs.sum(axis=1, keepdims=True)
        # Trigrams lean on pairs where they are rare.
        self.price = -np.log((counts + 20 * follow[None, :, :]) / (counts.sum(axis=2, keepdims=True) + 20))

    @staticmethod
    def suspicious(word: str) -> bool:
        """Whether a word has more than one reading."""
        if word.isalpha():
            return THRICE.search(word) is not None
        return any(mark in READINGS or mark in BETWEEN for mark in word) and any(map(str.isalpha, word))

    def restored(self, word: str) -> str:
        """The cheapest reading of a lower-case word, or of several single characters with blanks between."""
        n = len(word)
        # Per place that can be reached: for the two classes written last, the price so far and the way there.
        best: dict[int, dict] = defaultdict(dict)
        best[0][(BLANK, BLANK)] = (0.0, None, "")
        for at in range(n):
            if at not in best:
                continue
            for written, to, price in self._readings(word, at):
                # Of a long run the third letter costs what all later ones do.
                kinds = [int(CLASS_OF[min(ord(mark), len(CLASS_OF) - 1)]) for mark in written[:3]]
                for state, (so_far, _, _) in best[at].items():
                    total, (first, second), step = so_far + price, state, 0.0
                    for kind in kinds:
                        step = float(self.price[first, second, kind])
                        total += step
                        first, second = second, kind
                    if len(written) > 3:
                        total += (len(written) - 3) * step
                    old = best[to].get((first, second))
                    if old is None or total < old[0]:
                        best[to][(first, second)] = (total, (at, state), written)
        ends = {state: value[0] + float(self.price[state[0], state[1], BLANK]) for state, value in best[n].items()}
        at, state, parts = n, min(ends, key=ends.get), []
        while at or best[at][state][1]:
            _, came, written = best[at][state]
            parts.append(written)
            at, state = came
        return "".join(reversed(parts))

    @staticmethod
    def _readings(word: str, at: int) -> Iterator[tuple[str, int, float]]:
        mark = word[at]
        letters = READINGS.get(mark, "")
        run = at + 1
        if at == 0 or word[at - 1] != mark:  # a run is measured once, where it begins
            while run < len(word) and word[run] == mark:
                run += 1
        # The letters of a run have no reading of their own, so they are passed at once.
        alone = letters or mark in BETWEEN or run - at < 4
        yield (mark, at + 1, 0.0) if alone else (word[at:run], run, 0.0)
        if len(letters) < 20 or (word[at - 1 : at].isalpha() and word[at + 1 : at + 2].isalpha()):
            for letter in letters:
                yield letter, at + 1, SUBSTITUTED + math.log(len(letters))
        if run - at >= 3:
            for letter in [mark] if mark.isalpha() else letters:
                yield letter, run, COLLAPSED
                yield 2 * letter, run, COLLAPSED
        if mark in BETWEEN and 0 < at < len(word) - 1 and (at < 2 or word[at - 2] in BETWEEN or word[at + 2 : at + 3] in BETWEEN):
            yield "", at + 1, SKIPPED


# --- the evidence ------------------------------------------------------------------------


def features(word: str) -> list[str]:
    """A restored word and its beginnings, longest first."""
    return [word, *[f"{word[:size]}~" for size in PREFIXES if len(word) > size]]


class Reader:
    """Words of texts, restored. Words are remembered, the memory starts anew when full."""

    MOST_WORDS = 1 << 18

    def __init__(self, restorer: Restorer) -> None:
        self.restorer = restorer
        self.known: dict[str, tuple[str, ...]] = {}

    def words(self, shown: str) -> tuple[str, ...]:
        found = self.known.get(shown)
        if found is None:
            if len(self.known) > self.MOST_WORDS:
                self.known.clear()
            found = self.known[shown] = self._read(shown)
        return found

    def _read(self, shown: str) -> tuple[str, ...]:
        low = shown.lower()
        core = low.strip(".,;:?")
        if core.isalpha() and not THRICE.search(core):
            return (core,)
        bare = low.strip(EDGES)
        if not self.restorer.suspicious(low):
            return (bare,) if bare else ()
        # A mark at an edge may be a letter or punctuation: both are read. Several equal ones are no letters.
        forms = {bare, DECORATION.sub("", low)}
        readings = dict.fromkeys([bare, *[self.restorer.restored(form) for form in forms if self.restorer.suspicious(form)]])
        return tuple(dict.fromkeys(part for reading in readings for word in reading.split() if (part := word.strip(EDGES))))

    def text_words(self, text: str) -> set[str]:
        """All restored words of a text."""
        words = Words(pa.array([text]))
        shown = words.distinct.to_pylist() + [run for _, run in _spaced_out(words)]
        return {word for one in shown for word in self.words(one)}


def _spaced_out(words: Words) -> Iterator[tuple[int, str]]:
    """Runs of single characters, joined by blanks, with their text."""
    single = pc.equal(pc.utf8_length(words.words), 1).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(single)
    if not len(at):
        return
    breaks = np.flatnonzero((np.diff(at) > 1) | (np.diff(words.text[at]) > 0)) + 1
    for run in np.split(at, breaks):
        if len(run) >= SPACED:
            # The last character may be glued to a stop, so the next short word belongs to it.
            yield int(words.text[run[0]]), " ".join(words.words.take(pa.array(run)).to_pylist()).lower()


class Model:
    """A restorer, evidence by feature, and the curve."""

    def __init__(self, restorer: Restorer, evidence: dict[str, float | None], curve: np.ndarray | None) -> None:
        self.restorer, self.evidence, self.curve = restorer, evidence, curve
        self._reader, self._weights = Reader(restorer), {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_reader": Reader(self.restorer), "_weights": {}}

    def measures(self, texts: pa.Array) -> np.ndarray:
        """Per text: the strongest evidence of a word, and the evidence of all, damped."""
        words = Words(texts)
        if len(self._weights) > Reader.MOST_WORDS:
            self._weights.clear()
        weight = np.fromiter(map(self._weight, words.distinct.to_numpy(zero_copy_only=False).tolist()), float, len(words.distinct))
        strong = np.flatnonzero(weight[words.code] > 0)
        owners, weights = [words.text[strong]], [weight[words.code[strong]]]
        for text, shown in _spaced_out(words):
            owners.append(np.array([text]))
            weights.append(np.array([self._weight(shown)]))
        owner, weight = np.concatenate(owners), np.concatenate(weights)
        top = np.zeros(len(texts))
        np.maximum.at(top, owner, weight)
        return np.column_stack([top, np.log1p(np.bincount(owner, weight, len(texts)))])

    def _weight(self, shown: str) -> float:
        weight = self._weights.get(shown)
        if weight is None:
            weight = self._weights[shown] = max(map(self.weight, self._reader._read(shown)), default=0.0)
        return weight

    def weight(self, word: str) -> float:
        """The strongest evidence of a word; what clean documents alone have says nothing about its own beginnings."""
        best = 0.0
        for feature in features(word):
            weight = self.evidence.get(feature, 0.0)
            if weight is None:
                break
            best = max(best, weight)
        return best

    def scores(self, measures: np.ndarray) -> np.ndarray:
        if self.curve is None:
            return np.zeros(len(measures))
        return 1 / (1 + np.exp(-np.clip(_with_one(measures) @ self.curve, -500, 500)))


def learned(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """A model from all documents' characters and the labels outside the held-out fold."""
    restorer = Restorer(character_counts(documents, text))
    known = labels.select(F.col(key).cast("bigint").alias("key"), F.col(label).cast("int").alias("toxic"))
    known = known.where("key IS NOT NULL AND toxic IS NOT NULL").where(~held_out(F.col("key")))
    known = known.groupBy("key").agg(F.max("toxic").alias("toxic"))
    rank = F.xxhash64("key").alias("rank")
    classes = [known.where(F.col("toxic") == value).select("key", "toxic", rank).orderBy("rank", "key").limit(SAMPLE) for value in (0, 1)]
    # At most 2 * SAMPLE rows of three numbers.
    sample = F.broadcast(classes[0].unionByName(classes[1]).withColumn("half", F.pmod(F.hash("rank"), F.lit(2))))
    rows = documents.select(F.col(key).cast("bigint").alias("own"), F.col(text).alias("text"))
    rows = stored(_single(rows.join(sample, F.col("own") == F.col("key")).select("text", "toxic", "half")), "labelled-sample")
    n = {row["toxic"]: row["n"] for row in rows.where("half = 0").groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    evidence = _evidence(rows.where("half = 0"), restorer, n.get(1, 0), n.get(0, 0)) if len(n) == 2 else {}
    model = Model(restorer, evidence, None)
    share = known.agg(F.avg("toxic")).first()[0]
    return Model(restorer, evidence, _curve(rows.where("half = 1"), model, share) if evidence else None)


def _single(rows: DataFrame) -> DataFrame:
    """One of each group of near copies, so that no copied text's words pass for evidence.

    Copies are told by the smallest hash of their shingles. Texts of the sample only.
    """

    def mark(batch: pa.RecordBatch) -> pa.RecordBatch:
        lowest = []
        for value in filled(batch.column(0)).to_pylist():
            words = value.encode().lower().split()
            shingles = [b" ".join(words[at : at + SHINGLE]) for at in range(max(1, len(words) - SHINGLE + 1))]
            lowest.append(min(xxhash.xxh64_digest(shingle) for shingle in shingles))
        return batch.append_column("lowest", pa.array(lowest, pa.binary()))

    marked = map_texts(rows, mark, "text string, toxic int, half int, lowest binary", "text")
    return marked.groupBy("lowest", "toxic").agg(F.min(F.struct("half", "text")).alias("one")).select("one.text", "toxic", "one.half")


def _evidence(rows: DataFrame, restorer: Restorer, toxic: int, clean: int) -> dict[str, float | None]:
    """Cautious log-odds of the features that are met in toxic documents more than in others.

    Words come first; beginnings are then counted over the words that are no evidence by themselves.
    Features that begin like one of these and are met in clean documents only are None.
    """
    t, c = F.col("t") + 0.5, F.col("c") + 0.5
    odds = F.log(t / (toxic + 1)) - F.log(c / (clean + 1)) - CAUTION * F.sqrt(1 / t + 1 / c)

    def best(counted: DataFrame) -> dict[str, float]:
        strong = counted.where(f"t >= {LEAST_DOCUMENTS}").select("feature", odds.alias("weight")).where("weight > 0")
        return dict(map(tuple, strong.collect()))

    words = _counted(rows, restorer, lambda word: [word])
    found = best(words)
    explained = frozenset(found)
    beginnings = _counted(rows, restorer, lambda word: [] if word in explained else features(word)[1:])
    found |= best(beginnings)
    starts = sorted({feature[: min(PREFIXES)] for feature in found})
    if not starts:
        return {}
    known = F.broadcast(rows.sparkSession.createDataFrame([(start,) for start in starts], "start string"))
    alone = words.unionByName(beginnings).where("t = 0 AND c > 1")
    alone = alone.join(known, F.substring("feature", 1, min(PREFIXES)) == F.col("start"), "left_semi")
    cleared = alone.select("feature").collect()
    return found | {row["feature"]: None for row in cleared}


def _counted(rows: DataFrame, restorer: Restorer, named: Callable[[str], list[str]]) -> DataFrame:
    """In how many toxic (``t``) and clean (``c``) documents each feature is met."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, met = Reader(restorer), (Counter(), Counter())
        for batch in batches:
            kinds = batch.column(1).to_numpy()
            for value, kind in zip(filled(batch.column(0)).to_pylist(), kinds):
                met[int(kind > 0)].update({feature for word in reader.text_words(value) for feature in named(word)})
        names = list(met[0].keys() | met[1].keys())
        counts = [pa.array([met[kind][name] for name in names], pa.int64()) for kind in (1, 0)]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *counts], ["feature", "t", "c"])

    counted = rows.select("text", "toxic").mapInArrow(count, "feature string, t bigint, c bigint")
    return stored(counted.groupBy("feature").agg(F.sum("t").alias("t"), F.sum("c").alias("c")), "toxic-words")


def _curve(rows: DataFrame, model: Model, share: float) -> np.ndarray | None:
    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = model.measures(batch.column(0))
        return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1]), batch.column(1)], ["top", "total", "toxic"])

    measured = map_texts(rows.select("text", "toxic"), measure, "top double, total double, toxic int", "text")
    found = np.array([tuple(row) for row in measured.collect()], float).reshape(-1, 3)  # at most 2 * SAMPLE rows
    toxic = found[:, 2] > 0
    return _fitted(found[:, :2], toxic, share) if 0 < toxic.sum() < len(toxic) else None


def _with_one(measures: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(measures)), measures])


def _fitted(measures: np.ndarray, toxic: np.ndarray, positive: float, ridge: float = 0.1, steps: int = 50) -> np.ndarray:
    """Logistic regression by Newton's method; ``positive`` is the toxic class's share among all labels."""
    x, w = _with_one(measures), np.zeros(measures.shape[1] + 1)
    share = np.where(toxic, positive / toxic.sum(), (1 - positive) / (~toxic).sum()) * len(toxic)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        slope = x.T @ (share * (toxic - p)) - ridge * w
        bend = (x * (share * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        move = np.linalg.solve(bend, slope)
        w = w + move
        if np.abs(move).max() < 1e-9:
            break
    return w


# --- the operator ------------------------------------------------------------------------


def held_out(key):
    """Whether a row's label is kept for testing."""
    return F.coalesce(F.crc32(key.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def scored(documents: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted, evidence``."""

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        measures = model.measures(batch.column(2))
        values = model.scores(measures)
        columns = [batch.column(0), batch.column(1), pa.array(values), pa.array((values >= 0.5).astype(np.int32)), pa.array(measures[:, 0])]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted", "evidence"])

    own = F.col(key).cast("bigint")
    rows = documents.select(own.alias("doc_id"), held_out(own).alias("held_out"), F.col(text).alias("text"))
    schema = "doc_id bigint, held_out boolean, score double, predicted int, evidence double"
    return map_texts(rows, score, schema, "text")


def clean(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents that are not predicted toxic, with all their columns."""

    def choose(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = model.scores(model.measures(batch.column(text)))
        return batch.filter(pa.array(values < 0.5))

    return map_texts(documents, choose, documents.schema, text)
