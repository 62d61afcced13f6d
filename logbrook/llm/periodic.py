"""Periodic runs in texts, found on a grammar of each text.

Re-Pair writes a text's words as a grammar: the most frequent pair of
neighbours becomes a nonterminal, again and again, until no pair is left twice.
What remains is read as a balanced tree, so every stretch of words lies across
the boundary of one node: the last one that holds all of it. The runs that cross
a node's boundary are searched for once, in the node's own words, and then
translated to all places at which the grammar derives that node. A run that a
larger node sees in full covers what smaller nodes saw of it, so intervals of
one period are merged at the end.

A run has at least ``POWER`` periods and ``SHORTEST`` words. Of the two sides of
a boundary one holds half of the run, that is at least two periods. So periods
are distances at which the three words beside the boundary come again; a node
without such a distance in reach is crossed by no run and not looked at.

Null and empty texts have no words and no run. Every row is treated on its own:
repeated rows and repeated ids give repeated results, a null id stays null.
Extra columns are ignored. A text is held in memory by its task, with some 200
bytes a word; its time is in proportion to its words but for a logarithm.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logbrook.llm.batches import Words, map_texts, mixed

SHORTEST = 6
POWER = 4

SCHEMA = (
    "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint,"
    " runs_sha256 string, collapsed_sha256 string"
)
NAMES = [column.split()[0] for column in SCHEMA.split(", ")]

Run = tuple[int, int, int]
Reread = Callable[[int | None, int], np.ndarray | None]

LOW = (1 << 32) - 1
FAR = np.iinfo(np.int64).max // 8


class Grammar:
    """Re-Pair over one text.

    ``places[x]`` are all words at which nonterminal x begins in the text,
    ``parts[x]`` the lengths of its two sides; ``top`` are the words at which
    the symbols begin that are left. Equally frequent pairs are taken in the order of their numbers.
    """

    def __init__(self, symbols: list[int], pairs: dict[int, list[int]], first: int) -> None:
        """``pairs`` are the places of all pairs met twice, under ``left << 32 | right``; ``first`` the first free number."""
        n = len(symbols)
        symbols = [*symbols, -1]  # also what stands before the first word
        after, before = list(range(1, n + 1)), list(range(-1, n))
        counts = {pair: len(at) for pair, at in pairs.items()}
        heap = [(-count, pair) for pair, count in counts.items()]
        heapq.heapify(heap)
        self.places: list[list[int]] = []
        self.parts: list[tuple[int, int]] = []
        sizes: dict[int, int] = {}
        while heap:
            count, pair = heapq.heappop(heap)
            now = counts[pair]
            if now != -count:
                if now > 1:
                    heapq.heappush(heap, (-now, pair))
                continue
            a, b = pair >> 32, pair & LOW
            if a == b and not _twice(symbols, after, pairs[pair], a):
                continue
            new = first + len(self.parts)
            places = []
            for i in pairs.pop(pair):
                if symbols[i] != a:
                    continue
                j = after[i]
                if symbols[j] != b:
                    continue
                k, left = after[j], symbols[before[i]] << 32 | a
                if left in counts:
                    counts[left] -= 1
                right = b << 32 | symbols[k]
                if right in counts:
                    counts[right] -= 1
                symbols[i], symbols[j], after[i], before[k] = new, -1, k, i
                places.append(i)
            counts[pair] = 0
            self.places.append(places)
            self.parts.append((sizes.get(a, 1), sizes.get(b, 1)))
            sizes[new] = sum(self.parts[-1])
            met: dict[int, list[int]] = {}
            for i in places:
                h, k = before[i], after[i]
                left, right = symbols[h], symbols[k]
                if left >= 0:
                    met.setdefault(left << 32 | new, []).append(h)
                if right >= 0 and right != new:
                    met.setdefault(new << 32 | right, []).append(i)
            for code, at in met.items():
                if len(at) > 1:
                    pairs[code], counts[code] = at, len(at)
                    heapq.heappush(heap, (-len(at), code))
        self.top = [at for at in range(n) if symbols[at] >= 0]


def _twice(symbols: list[int], after: list[int], places: list[int], a: int) -> bool:
    """Whether a pair of equal symbols stands at two places that do not overlap."""
    found, free = 0, -1
    for i in places:
        if i >= free and symbols[i] == a and symbols[after[i]] == a:
            found, free = found + 1, after[after[i]]
            if found == 2:
                return True
    return False


def _pairs(text: np.ndarray, code: np.ndarray) -> Iterator[tuple[int, int, list[int]]]:
    """Text, pair and places of every pair of neighbours a text has more than once, by text."""
    at = np.flatnonzero(text[1:] == text[:-1])
    key = code[at] << 32 | code[at + 1]
    order = np.lexsort((key, text[at]))
    at, key = at[order], key[order]
    owner = text[at]
    new = np.ones(len(at) + 1, bool)
    new[1:-1] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    starts = np.flatnonzero(new)
    often = np.flatnonzero(np.diff(starts) > 1)
    lows, highs = starts[often], starts[often + 1]
    for low, high, pair, whose in zip(lows.tolist(), highs.tolist(), key[lows].tolist(), owner[lows].tolist()):
        yield whose, pair, at[low:high].tolist()


class _Triples:
    """The triples of neighbouring words, as numbers, and how far the same one is in either direction."""

    def __init__(self, text: np.ndarray, code: np.ndarray) -> None:
        n = len(code)
        self.mix = np.zeros(n, np.uint64)
        self.ahead, self.back = np.full(n, FAR), np.full(n, FAR)
        if n < 3:
            return
        word = code.astype(np.uint64)
        mix = mixed(mixed(mixed(mixed(text[:-2]) ^ word[:-2]) ^ word[1:-1]) ^ word[2:])
        self.mix[:-2] = mix
        at = np.flatnonzero(text[2:] == text[:-2])
        at = at[np.argsort(mix[at], kind="stable")]
        same = mix[at[1:]] == mix[at[:-1]]
        step = (at[1:] - at[:-1])[same]
        self.ahead[at[:-1][same]] = step
        self.back[at[1:][same]] = step


class _Nodes:
    """Derivation nodes as three columns: first word, boundary, end."""

    def __init__(self) -> None:
        self.low: list[np.ndarray] = []
        self.cut: list[np.ndarray] = []
        self.high: list[np.ndarray] = []

    def add(self, low: np.ndarray, cut: np.ndarray, high: np.ndarray) -> None:
        self.low.append(low)
        self.cut.append(cut)
        self.high.append(high)

    def columns(self) -> list[np.ndarray]:
        return [np.concatenate(column) if column else np.zeros(0, np.int64) for column in (self.low, self.cut, self.high)]


def runs(text: np.ndarray, code: np.ndarray, n_texts: int) -> list[list[Run]]:
    """For each text its runs ``(start, length, period)`` by start and period.

    ``text`` gives each word's text, in order, and ``code`` a number that equal words share.
    """
    ends = np.cumsum(np.bincount(text, minlength=n_texts)).tolist()
    first = int(code.max()) + 1 if len(code) else 0
    nodes, places, repeated = _Nodes(), [], _pairs(text, code)
    held = next(repeated, None)
    start = 0
    for number, end in enumerate(ends):
        if end - start < SHORTEST:
            while held is not None and held[0] == number:
                held = next(repeated, None)
            start = end
            continue
        pairs = {}
        while held is not None and held[0] == number:
            pairs[held[1]] = [at - start for at in held[2]]
            held = next(repeated, None)
        grammar = Grammar(code[start:end].tolist(), pairs, first)
        if grammar.parts:
            parts = np.array(grammar.parts, np.int64)
            low = np.fromiter((at[0] for at in grammar.places), np.int64, len(parts)) + start
            nodes.add(low, low + parts[:, 0], low + parts.sum(axis=1))
            places += [(start, at) for at in grammar.places]
        # The symbols left are leaves of a balanced tree: the lowest bit of a boundary's number is its height.
        top = np.array([*grammar.top, end - start], np.int64) + start
        cut = np.arange(1, len(top) - 1)
        reach = cut & -cut
        nodes.add(top[cut - reach], top[cut], top[np.minimum(cut + reach, len(top) - 1)])
        places += [(start, None)] * len(cut)
        start = end
    return _translated(text, code, nodes, places, [0, *ends])


def _translated(
    text: np.ndarray, code: np.ndarray, nodes: _Nodes, places: list[tuple[int, list[int] | None]], borders: list[int]
) -> list[list[Run]]:
    """The runs across all nodes' boundaries, at all places of the nodes, merged."""
    low, cut, high = nodes.columns()
    triples = _Triples(text, code)
    found: list[set[Run]] = [set() for _ in borders[1:]]
    for node in np.flatnonzero(_crossable(code, triples, low, cut, high)).tolist():
        l, m, h = int(low[node]), int(cut[node]), int(high[node])
        across = _crossing(code, triples.mix, l, m, h)
        if across:
            start, derived = places[node]
            own = found[int(text[l])]
            for at in derived if derived is not None else [l - start]:
                own.update((period, at + begin - l, at + end - l) for begin, end, period in across)
    return [_merged(intervals) for intervals in found]


def _crossable(code: np.ndarray, triples: _Triples, low: np.ndarray, cut: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Nodes whose boundary has the same words again beside it, near enough for a run of the node's length."""
    left, right, whole = cut - low, high - cut, high - low
    last = len(code) - 1

    def word(at: np.ndarray) -> np.ndarray:
        return code[np.clip(at, 0, last)]

    def side(length: np.ndarray, at: np.ndarray, step: int, distance: np.ndarray) -> np.ndarray:
        near = (2 * distance <= length) & (POWER * distance <= whole)
        one = (length >= 3) & (word(at) == word(at + step)) & (word(at) == word(at + 2 * step))
        two = (length >= 4) & (word(at) == word(at + 2 * step)) & (word(at + step) == word(at + 3 * step))
        return near | one | two

    if not len(low):
        return np.zeros(0, bool)
    ahead = triples.ahead[cut]
    back = np.where(cut >= 3, triples.back[np.maximum(cut - 3, 0)], FAR)
    return (whole >= SHORTEST) & (side(right, cut, 1, ahead) | side(left, cut - 1, -1, back))


def _crossing(code: np.ndarray, mix: np.ndarray, low: int, cut: int, high: int) -> list[tuple[int, int, int]]:
    """Start, end and period of the runs inside [low, high) that reach over the boundary, as far as they go there."""
    found = set(_half(code, mix, low, cut, high))
    n = len(code)
    turned = _half(code[::-1], mix[: max(0, n - 2)][::-1], n - high, n - cut, n - low)
    return sorted(found | {(n - end, n - start, period) for start, end, period in turned})


def _half(code: np.ndarray, mix: np.ndarray, low: int, cut: int, high: int) -> Iterator[tuple[int, int, int]]:
    """The runs with two periods or more behind the boundary.

    Once the words behind it have a period as far as ``reach``, a longer period
    that comes twice within that stretch is a multiple and no smallest one.
    """
    most = (high - cut) // 2
    near = mix[cut + 3 : cut + most + 1]
    periods = [1, 2]
    if cut < len(mix):
        periods += (np.flatnonzero(near == mix[cut]) + 3).tolist()
    reach = 0
    for period in periods:
        if period > most or 2 * period <= reach:
            continue
        behind = _agree(code[cut:high], code[cut + period : high])
        if behind < period:
            continue
        reach = period + behind
        ahead = _agree(code[low:cut][::-1], code[low + period : cut + period][::-1])
        start, end = cut - ahead, cut + reach
        if end - start >= max(SHORTEST, POWER * period):
            yield start, end, period


def _agree(left: np.ndarray, right: np.ndarray) -> int:
    """How many words two stretches have in common from their beginnings on."""
    n = min(len(left), len(right))
    at, step = 0, 32
    while at < n:
        end = min(n, at + step)
        apart = left[at:end] != right[at:end]
        if apart.any():
            return at + int(apart.argmax())
        at, step = end, 4 * step
    return n


def _merged(intervals: set[Run]) -> list[Run]:
    """Intervals of one period that share a period's length or more are one run."""
    runs: list[list[int]] = []
    for period, start, end in sorted(intervals):
        if runs and runs[-1][2] == period and start + period <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([start, end, period])
    return sorted((start, end - start, period) for start, end, period in runs)


def collapsed(n_words: int, found: list[Run]) -> np.ndarray:
    """Which words stay: of every run the first period, and what no run holds."""
    change = np.zeros(n_words + 1, np.int64)
    for start, length, period in found:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) == 0


def found(
    documents: DataFrame, key: str = "doc_id", text: str = "text", reread: Reread | None = None
) -> DataFrame:
    """One row per document: its number of runs, the longest one, and digests of all runs and of the words that stay.

    With ``reread``, a function of a document's id and number of words, each
    place holds the word whose number that function gives (None: its own).
    """

    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = _rows(batch.column(0).to_pylist(), Words(batch.column(1)), reread)
        return pa.RecordBatch.from_arrays([pa.array(column) for column in zip(*rows)], schema=_ARROW)

    return map_texts(documents.select(F.col(key).cast("bigint").alias("doc_id"), text), scan, SCHEMA, text)


_ARROW = pa.schema(
    [(name, pa.string() if name.endswith("sha256") else pa.int64()) for name in NAMES]
)


def _rows(keys: list[int | None], words: Words, reread: Reread | None) -> Iterator[tuple]:
    code = words.code
    borders = [0, *np.cumsum(words.per_text()).tolist()]
    spans = list(zip(borders, borders[1:]))
    if reread is not None:
        code = code.copy()
        for key, (start, end) in zip(keys, spans):
            order = reread(key, end - start)
            if order is not None:
                code[start:end] = words.code[start:end][order]
    distinct = words.distinct.to_pylist()
    for key, (start, end), own in zip(keys, spans, runs(words.text, code, words.n_texts)):
        kept = code[start:end]
        if own:
            kept = kept[collapsed(end - start, own)]
        longest = max(own, key=lambda run: (run[1], -run[0], -run[2]), default=None)
        shown = (*longest, 1000 * longest[1] // longest[2]) if longest else (None,) * 4
        listed = "".join(f"{run[0]},{run[1]},{run[2]}\n" for run in own)
        left = " ".join([distinct[word] for word in kept.tolist()])
        yield key, len(own), *shown, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(left.encode()).hexdigest()
