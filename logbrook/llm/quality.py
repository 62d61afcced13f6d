"""Quality rules on compression: texts that zstandard packs too well repeat themselves, texts it hardly packs are noise.

A text's ratio is its compressed size over its size in UTF-8. How far a text
packs depends on its length, so the accepted band does too (``BANDS``). Beside
the whole text, chunks of ``CHUNK_BYTES`` are held against the same bands, which
finds a text that is bad in part. Every text longer than one chunk is cut so; its
last chunk ends where it ends and may overlap the one before. Noise of few
characters, such as hexadecimal digits, packs like prose and is not told by ratios.

Null texts count as empty. An empty text has ratio 1 and fails by its word
count. Repeated rows and repeated ids are judged one by one; extra columns are
ignored by ``verdicts`` and handed through by ``kept``.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame

from logbrook.llm.batches import Words, filled, map_texts, mixed

LEVEL = 3
CHUNK_BYTES = 4096
BAD_SHARE = 0.3
"""The largest share of a text's chunks that may lie outside their band."""

BANDS = (
    (0, 0.40, 2.00),
    (256, 0.47, 0.92),
    (512, 0.46, 0.80),
    (1024, 0.44, 0.72),
    (2048, 0.43, 0.66),
    (4096, 0.41, 0.62),
    (8192, 0.40, 0.60),
    (16384, 0.385, 0.58),
    (32768, 0.37, 0.57),
    (65536, 0.35, 0.56),
)
"""From how many bytes on, the lowest and the highest accepted ratio."""

MIN_WORDS = 50
FROM = [start for start, _, _ in BANDS]

SCHEMA = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint,"
    " base_failed boolean, kept boolean, ratio double, bad_chunks bigint, chunks bigint"
)


def verdicts(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: the base counts, the ratios and whether it is kept."""

    def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = judged(batch.column(1))
        return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *map(pa.array, found.values())], ["doc_id", *found])

    return map_texts(documents.select(key, text), judge, SCHEMA, text)


def kept(documents: DataFrame, text: str = "text") -> DataFrame:
    """The documents that pass, with all their columns."""

    def choose(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(judged(batch.column(text))["kept"]))

    return map_texts(documents, choose, documents.schema, text)


def judged(texts: pa.Array) -> dict[str, np.ndarray]:
    """All measures of some texts, by name."""
    found = base_counts(texts)
    ratios = [_ratios(value.encode()) for value in filled(texts).to_pylist()]
    ratio, within, bad, chunks = (np.array(values) for values in zip(*ratios))
    found["kept"] = ~found["base_failed"] & within & (bad <= BAD_SHARE * chunks)
    return found | {"ratio": ratio, "bad_chunks": bad, "chunks": chunks}


def within_band(size: int, ratio: float) -> bool:
    _, low, high = BANDS[bisect.bisect_right(FROM, size) - 1]
    return low <= ratio <= high


def _ratios(data: bytes) -> tuple[float, bool, int, int]:
    """Whole ratio, whether it lies in its band, chunks outside theirs and all chunks."""
    if not data:
        return 1.0, True, 0, 0
    packer = zstandard.ZstdCompressor(level=LEVEL)
    ratio = len(packer.compress(data)) / len(data)
    bad = chunks = 0
    if len(data) > CHUNK_BYTES:
        for start in range(0, len(data), CHUNK_BYTES):
            start = min(start, len(data) - CHUNK_BYTES)
            chunk = data[start : start + CHUNK_BYTES]
            bad += not within_band(CHUNK_BYTES, len(packer.compress(chunk)) / CHUNK_BYTES)
            chunks += 1
    return ratio, within_band(len(data), ratio), bad, chunks


def base_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """The counts every text gets, whatever its ratio."""
    texts = filled(texts)
    words = Words(texts)
    n_words = words.per_text()
    n_repeat = _repeated_words(words)
    return {
        "n_words": n_words,
        "word_chars": words.per_text(pc.utf8_length(words.words).to_numpy(zero_copy_only=False).astype(np.int64)),
        "n_symbols": _symbols(texts),
        "n_dup_lines": _duplicate_lines(texts),
        "n_repeat_words": n_repeat,
        "base_failed": (n_words < MIN_WORDS) | (100 * n_repeat > 50 * n_words),
    }


def _symbols(texts: pa.Array) -> np.ndarray:
    """Characters of ``#*$%&|<>``, found in the texts' bytes at once."""
    lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    flags = np.zeros(256, bool)
    flags[list(b"#*$%&|<>")] = True
    at = np.flatnonzero(flags[np.frombuffer(b"".join(pc.cast(texts, pa.binary()).to_pylist()), np.uint8)])
    owner = np.searchsorted(np.cumsum(lengths), at, side="right")
    return np.bincount(owner, minlength=len(texts)).astype(np.int64)


def _duplicate_lines(texts: pa.Array) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    split = pc.split_pattern(texts, "\n")
    lines = split.flatten()
    text = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy(zero_copy_only=False))
    solid = pc.not_equal(pc.ascii_trim_whitespace(lines), "")
    lines, text = lines.filter(solid), text[solid.to_numpy(zero_copy_only=False)]
    coded = lines.dictionary_encode()
    width = max(1, len(coded.dictionary))
    first = np.unique(text * width + coded.indices.to_numpy(zero_copy_only=False)) // width
    return np.bincount(text, minlength=len(texts)) - np.bincount(first, minlength=len(texts))


def _repeated_words(words: Words) -> np.ndarray:
    """Words that lie in a window of three words which their text has more than once.

    Windows are compared by a 64-bit mix of text and words, then word by word.
    """
    text, code = words.text, words.code
    covered = np.zeros(len(code), bool)
    if len(code) >= 3:
        at = np.flatnonzero(text[2:] == text[:-2])
        mix = mixed(mixed(mixed(mixed(text[at]) ^ code[at].astype(np.uint64)) ^ code[at + 1].astype(np.uint64)) ^ code[at + 2].astype(np.uint64))
        order = np.argsort(mix, kind="stable")
        at, mix = at[order], mix[order]
        same = mix[1:] == mix[:-1]
        for step in range(3):
            same &= code[at[1:] + step] == code[at[:-1] + step]
        for window in (at[1:][same], at[:-1][same]):
            for step in range(3):
                covered[window + step] = True
    return np.bincount(text[covered], minlength=words.n_texts).astype(np.int64)
