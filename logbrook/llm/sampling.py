"""Sampled segmentations under a SentencePiece vocabulary, and their lossless way back.

Every text gets a blank in front, and its blanks become marks that open words.
The pieces that match a word form a lattice. Forward filtering sums the weight
of all ways to each place; backward sampling then walks from the end, taking each piece
with the probability that the ways through it have. Chance comes from a counter:
a hash of the row's key, the word's place and the step. So a row has one
segmentation under one seed, whatever task or batch it is in.

A piece weighs ``(rank + 3) ** -sharpness``, as its rank is all that a vocabulary of
merges says about how common it is. Pieces hold a blank only in front, so the words of
a text are independent and each distinct word is filtered once; all of its
occurrences are sampled together. A character without a piece goes through the
byte pieces, also the mark for blanks itself where the text has it. So decoding
gives back any text.

Defined results: null and empty texts are the blank in front alone and decode to
the empty text. A null key counts as one key; rows that repeat key and text repeat their ids.
Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logbrook.llm.batches import filled, map_texts, mixed
from logbrook.llm.tokens import tokenizer_path

MODEL = "piece_bpe_32k.model"
SEED = 7
SHARPNESS = 1.0
BYTE_RANK = 50_000
BLANK = "▁"
LEAST_WEIGHT = 1e-100
SHORT = 40
SOME_WORDS = 1 << 14
MOST_CHARACTERS = 32
"""No piece is longer."""


class Vocabulary:
    """The pieces of a model file, their weights, and the lattices of words."""

    def __init__(self, path: str, sharpness: float = SHARPNESS) -> None:
        self.path, self.sharpness, self._ready = path, sharpness, False

    def __getstate__(self) -> dict:
        return {"path": self.path, "sharpness": self.sharpness, "_ready": False}

    def load(self) -> Vocabulary:
        if self._ready:
            return self
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=self.path)
        self.bytes_of: list[bytes] = []
        self.octets = [0] * 256
        # Every beginning of a piece; pieces themselves with number and weight.
        self.known: dict[str, tuple[int, float] | tuple[()]] = {}
        rank = 0
        for piece in range(model.get_piece_size()):
            shown = model.id_to_piece(piece)
            if model.is_byte(piece):
                self.octets[int(shown[3:5], 16)] = piece
                self.bytes_of.append(bytes([int(shown[3:5], 16)]))
            elif model.is_control(piece) or model.is_unknown(piece) or BLANK in shown[1:]:
                self.bytes_of.append(b"")
            else:
                for size in range(1, len(shown)):
                    self.known.setdefault(shown[:size], ())
                self.known[shown] = piece, (rank + 3) ** -self.sharpness
                rank += 1
                self.bytes_of.append(shown.replace(BLANK, " ").encode())
        self.byte_weight = BYTE_RANK**-self.sharpness
        self._arrays()
        self._ready = True
        return self

    def _arrays(self) -> None:
        """The trie of the pieces as sorted steps (state and character) to states, and what needs no chain of bytes."""
        numbers = {"": 0} | {beginning: number for number, beginning in enumerate(self.known, 1)}
        steps = sorted(((numbers[shown[:-1]] << 21) | ord(shown[-1]), number) for shown, number in numbers.items() if shown)
        self.steps, self.to = np.array(steps, np.int64).T.copy()
        self.piece_at, self.weight_at = np.full(len(numbers), -1, np.int64), np.zeros(len(numbers))
        self.plain = np.zeros(1 << 16, bool)
        self.plain[:128] = True
        self.lone = np.ones(128, bool)
        for shown, found in self.known.items():
            if found:
                self.piece_at[numbers[shown]], self.weight_at[numbers[shown]] = found
                if len(shown) == 1 and ord(shown) < len(self.plain) - 1:
                    self.plain[ord(shown)] = True
                    if ord(shown) < 128:
                        self.lone[ord(shown)] = False
        self.plain[ord(BLANK)] = False

    def filtered(self, word: str, counts: list[int], edges: list[float]) -> None:
        """Append the lattice of a word without blanks, behind a blank: for each node, how many edges lead to it, and of
        each edge the node before, the piece and the weight of all ways that end with it.

        A character without a piece is a chain of nodes, one per byte, so nodes are numbered as they are made, and a
        place in the word has the number of its last node. Weights of the ways to one node are right up to a
        factor: when they become very small, all ways in reach are raised alike.
        """
        text = BLANK + word
        known, n = self.known, len(text)
        into: list[list[float]] = [[] for _ in range(n + 1)]
        ways = [0.0] * (n + 1)
        ways[0] = 1.0
        number = 0
        counts.append(0)
        for start in range(n):
            if start:
                number += 1
                counts.append(len(into[start]) // 3)
                edges += into[start]
                if ways[start] < LEAST_WEIGHT:
                    factor = 1 / ways[start]
                    for place in range(start, min(n + 1, start + MOST_CHARACTERS)):
                        ways[place] *= factor
                        into[place][2::3] = [weight * factor for weight in into[place][2::3]]
            here = ways[start]
            first = text[start]
            literal = first == BLANK and start > 0
            if literal or not known.get(first):
                weight, before = here, number
                octets = first.encode()
                for octet in octets[:-1]:
                    weight *= self.byte_weight
                    counts.append(1)
                    edges += (before, self.octets[octet], weight)
                    number += 1
                    before = number
                weight *= self.byte_weight
                into[start + 1] += (before, self.octets[octets[-1]], weight)
                ways[start + 1] += weight
                source = number - len(octets) + 1
                if literal:
                    continue
            else:
                source = number
            for end in range(start + 1, n + 1):
                found = known.get(text[start:end])
                if found is None:
                    break
                if found:
                    weight = here * found[1]
                    into[end] += (source, found[0], weight)
                    ways[end] += weight
        counts.append(len(into[n]) // 3)
        edges += into[n]


def encoded(vocabulary: Vocabulary, keys: np.ndarray, texts: pa.Array, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Sampled ids of some texts in a row, and where each text ends. ``keys`` are 64-bit numbers."""
    vocabulary.load()
    split = pc.split_pattern(filled(texts), " ")
    sizes = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = split.flatten().dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    text = np.repeat(np.arange(len(texts)), sizes)
    place = np.arange(len(code)) - np.repeat(np.cumsum(sizes) - sizes, sizes)

    # The lattices of all distinct words, end to end: edges sorted by the node they lead to.
    counts, before, pieces, weights, stops = _lattices(vocabulary, coded.dictionary.to_numpy(zero_copy_only=False).tolist())
    ends = np.cumsum(counts)
    # Running shares within a node, each node one step further up.
    ladder = _shares(weights, counts, ends) + np.repeat(np.arange(len(counts)), counts)
    is_start = counts == 0

    stream = mixed(keys.astype(np.int64).view(np.uint64) ^ mixed(np.array([seed], np.uint64)))
    state = mixed(stream[text] ^ mixed(place))
    node = stops[code] - 1 if len(code) else np.zeros(0, np.int64)
    active, taken, step = np.arange(len(code)), [], 0
    while len(active):
        chance = (mixed(state[active] + np.uint64(step)) >> np.uint64(11)) * 2.0**-53
        edge = np.searchsorted(ladder, node + chance, side="right")
        edge = np.minimum(edge, ends[node] - 1)
        taken.append((active, pieces[edge]))
        node = before[edge]
        going = ~is_start[node]
        active, node, step = active[going], node[going], step + 1
    steps = np.zeros(len(code), np.int64)
    for words, _ in taken:
        steps[words] += 1
    upto = np.cumsum(steps)
    ids = np.empty(upto[-1] if len(upto) else 0, np.uint32)
    for number, (words, chosen) in enumerate(taken):
        ids[upto[words] - 1 - number] = chosen
    last_word = np.cumsum(sizes) - 1
    return ids, upto[last_word] if len(upto) else np.zeros(len(texts), np.int64)


def _lattices(vocabulary: Vocabulary, words: list[str]) -> tuple[np.ndarray, ...]:
    """The lattices of all words: edges per node; node before, piece and weight per edge; nodes up to each word's end."""
    parts, stops, nodes = [], np.zeros(len(words), np.int64), 0
    for start in range(0, len(words), SOME_WORDS):
        some = words[start : start + SOME_WORDS]
        joined = np.frombuffer("".join(some).encode("utf-32-le"), np.uint32)
        lengths = np.fromiter(map(len, some), np.int64, len(some))
        odd = np.zeros(len(some), bool)
        odd[np.repeat(np.arange(len(some)), lengths)[~vocabulary.plain[np.minimum(joined, len(vocabulary.plain) - 1)]]] = True
        odd |= lengths >= SHORT
        for chosen, build in ((np.flatnonzero(~odd), _together), (np.flatnonzero(odd), _one_by_one)):
            if len(chosen):
                counts, before, pieces, weights, ends = build(vocabulary, [some[at] for at in chosen])
                parts.append((counts, (before + nodes).astype(np.int32), pieces, weights))
                stops[start + chosen] = ends + nodes
                nodes += len(counts)
    if not parts:
        return tuple(np.zeros(0, kind) for kind in (np.int32, np.int32, np.uint32, np.float64, np.int64))
    return *[np.concatenate(columns) for columns in zip(*parts)], stops


def _one_by_one(vocabulary: Vocabulary, words: list[str]) -> tuple[np.ndarray, ...]:
    degrees: list[int] = []
    flat: list[float] = []
    ends = []
    for word in words:
        vocabulary.filtered(word, degrees, flat)
        ends.append(len(degrees))
    counts, ends = np.array(degrees, np.int32), np.array(ends, np.int64)
    table = np.array(flat, np.float64).reshape(-1, 3)
    nodes = np.diff(ends, prepend=0)
    base = np.repeat(np.repeat(ends - nodes, nodes), counts)
    return counts, table[:, 0].astype(np.int64) + base, table[:, 1].astype(np.uint32), table[:, 2].copy(), ends


def _together(vocabulary: Vocabulary, words: list[str]) -> tuple[np.ndarray, ...]:
    """The same for short words whose characters need no chain of bytes: all walk down the pieces' trie at once."""
    marks = np.frombuffer((BLANK + BLANK.join(words)).encode("utf-32-le"), np.uint32).astype(np.int64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    word = np.repeat(np.arange(len(words)), lengths)
    end = np.cumsum(lengths)[word]
    at, state, depth = np.arange(len(marks)), np.zeros(len(marks), np.int64), 0
    found = []
    # A single byte stands for a character without a piece of its own.
    lone = np.flatnonzero(vocabulary.lone[np.minimum(marks, 127)] & (marks < 128))
    octets = np.array(vocabulary.octets, np.int64)
    found.append((lone, np.ones(len(lone), np.int64), octets[marks[lone]], np.full(len(lone), vocabulary.byte_weight)))
    while len(at):
        step = (state << 21) | marks[at + depth]
        place = np.minimum(np.searchsorted(vocabulary.steps, step), len(vocabulary.steps) - 1)
        known = vocabulary.steps[place] == step
        at, state = at[known], vocabulary.to[place[known]]
        depth += 1
        piece = vocabulary.piece_at[state]
        whole = piece >= 0
        found.append((at[whole], np.full(whole.sum(), depth), piece[whole], vocabulary.weight_at[state[whole]]))
        going = at + depth < end[at]
        at, state = at[going], state[going]
    source, size, piece, weight = (np.concatenate(columns) for columns in zip(*found))
    # Each word has a node more than characters.
    before, after = source + word[source], source + size + word[source]
    order = np.argsort(after * 64 - size, kind="stable")
    before, after, piece, weight = before[order], after[order], piece[order], weight[order]
    nodes = len(marks) + len(words)
    first = np.cumsum(lengths + 1) - lengths - 1
    ways = np.zeros(nodes)
    ways[first] = 1.0
    height = after - np.repeat(first, lengths + 1)[after]
    by_height = np.argsort(height, kind="stable")
    for edges in np.split(by_height, np.flatnonzero(np.diff(height[by_height])) + 1):
        weight[edges] *= ways[before[edges]]
        np.add.at(ways, after[edges], weight[edges])
    counts = np.bincount(after, minlength=nodes).astype(np.int32)
    return counts, before, piece.astype(np.uint32), weight, first + lengths + 1


def _shares(weights: np.ndarray, counts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Running share of each edge among those into its node, summed node by node so that small weights keep their digits."""
    largest = np.zeros(len(counts))
    owner = np.repeat(np.arange(len(counts)), counts)
    np.maximum.at(largest, owner, weights)
    scaled = weights / largest[owner]
    running = scaled.copy()
    place = np.arange(len(weights)) - (ends - counts)[owner]
    for step in range(1, int(counts.max(initial=0))):
        at = np.flatnonzero(place == step)
        running[at] += running[at - 1]
    return running / running[ends[owner] - 1]


def decoded(vocabulary: Vocabulary, ids: list[int]) -> str:
    """The text that ids were sampled from."""
    of = vocabulary.load().bytes_of
    return b"".join([of[piece] for piece in ids]).decode()[1:]


def _keys(column: pa.Array) -> np.ndarray:
    return column.fill_null(-1).to_numpy(zero_copy_only=False)


def encode(
    documents: DataFrame, key: str = "doc_id", text: str = "text", model: str | None = None, seed: int = SEED
) -> DataFrame:
    """``doc_id, ids``: the sampled segmentation of each text."""
    vocabulary = Vocabulary(model or tokenizer_path(MODEL))

    def sample(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, ends = encoded(vocabulary, _keys(batch.column(0)), batch.column(1), seed)
        offsets = pa.array(np.append(0, ends), pa.int32())
        return pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(ids.view(np.int32)))], ["doc_id", "ids"])

    return map_texts(documents.select(F.col(key).cast("bigint").alias("doc_id"), text), sample, "doc_id bigint, ids array<int>", text)


def decode(encoded_rows: DataFrame, key: str = "doc_id", ids: str = "ids", model: str | None = None) -> DataFrame:
    """``doc_id, text``; null ids give a null text."""
    vocabulary = Vocabulary(model or tokenizer_path(MODEL))

    def back(batches):
        for batch in batches:
            texts = [None if own is None else decoded(vocabulary, own) for own in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded_rows.select(F.col(key).cast("bigint").alias("doc_id"), ids).mapInArrow(back, "doc_id bigint, text string")


def digests(
    documents: DataFrame, key: str = "doc_id", text: str = "text", model: str | None = None, seed: int = SEED
) -> DataFrame:
    """``doc_id, n_tokens, ids_crc32, text_sha256``: encoded and, from the ids alone, decoded again."""
    vocabulary = Vocabulary(model or tokenizer_path(MODEL))

    def both(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, ends = encoded(vocabulary, _keys(batch.column(0)), batch.column(1), seed)
        starts = np.append(0, ends[:-1])
        shown = [decoded(vocabulary, ids[start:end].tolist()) for start, end in zip(starts, ends)]
        crc = [zlib.crc32(ids[start:end].astype("<u4").tobytes()) for start, end in zip(starts, ends)]
        columns = [batch.column(0), pa.array(ends - starts), pa.array(crc, pa.int64())]
        columns.append(pa.array([hashlib.sha256(value.encode()).hexdigest() for value in shown], pa.string()))
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_crc32", "text_sha256"])

    schema = "doc_id bigint, n_tokens bigint, ids_crc32 bigint, text_sha256 string"
    return map_texts(documents.select(F.col(key).cast("bigint").alias("doc_id"), text), both, schema, text)
