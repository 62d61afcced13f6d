"""Texts as Arrow batches: the way every operator here reads documents.

Texts are handled in pieces of at most ``CHUNK`` bytes (one longer text is a
piece of its own), so a task's memory does not depend on how many rows a batch
holds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from logbrook.session import work_dir

CHUNK = 4 << 20


def filled(texts: pa.Array) -> pa.Array:
    """Texts with null as the empty text."""
    return pc.fill_null(texts, "")


def pieces(batch: pa.RecordBatch, text: str, chunk: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch with at most ``chunk`` bytes of text each."""
    if not batch.num_rows:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    start, held = 0, 0
    if lengths.sum() <= chunk:
        yield batch
        return
    for at, length in enumerate(lengths.tolist()):
        if at > start and held + length > chunk:
            yield batch.slice(start, at - start)
            start, held = at, 0
        held += length
    yield batch.slice(start)


def map_texts(
    rows: DataFrame,
    function: Callable[[pa.RecordBatch], pa.RecordBatch],
    schema: T.StructType | str,
    text: str,
    chunk: int = CHUNK,
) -> DataFrame:
    """Apply a function to the rows' batches, piece by piece. Nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, text, chunk):
                yield function(piece)
            pa.default_memory_pool().release_unused()

    return rows.mapInArrow(run, schema)


class Words:
    r"""The words ``[^\x20\x09-\x0D]+`` of many texts, side by side.

    ``text`` is the index of each word's text, ``code`` a number that equal
    words share, ``distinct`` the words by that number.
    """

    def __init__(self, texts: pa.Array) -> None:
        split = pc.ascii_split_whitespace(filled(texts))
        words = split.flatten()
        text = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy(zero_copy_only=False))
        solid = pc.not_equal(words, "")
        self.n_texts = len(texts)
        self.words = words.filter(solid)
        self.text = text[solid.to_numpy(zero_copy_only=False)]
        coded = self.words.dictionary_encode()
        self.code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.distinct = coded.dictionary

    def per_text(self, values: np.ndarray | None = None) -> np.ndarray:
        """Word counts of the texts, or sums of a value of the words."""
        counted = np.bincount(self.text, values, self.n_texts)
        return counted.astype(np.int64) if values is None or values.dtype.kind in "ib" else counted


def mixed(values: np.ndarray) -> np.ndarray:
    """64-bit numbers stirred so that all bits depend on all bits (splitmix64)."""
    z = values.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def free_name(rows: DataFrame, name: str) -> str:
    """The name, lengthened until no column of the rows has it."""
    taken = {column.lower() for column in rows.columns}
    while name.lower() in taken:
        name += "_"
    return name


def stored(rows: DataFrame, label: str) -> DataFrame:
    """The rows written to the session's shared folder and read again: lineage is cut, and lost executors lose nothing."""
    spark = rows.sparkSession
    path = work_dir(spark, label)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Sorted batches cut anew, so that no group of equal keys is cut; groups must be of bounded size."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        if not len(keys):
            continue
        last = int(np.searchsorted(keys, keys[-1]))
        if last:
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = []
        elif held and held[-1].column(key)[-1].as_py() != keys[0]:
            yield pa.Table.from_batches(held)
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held)


class Forest:
    """Groups of linked items, each named by its smallest item."""

    def __init__(self, size: int) -> None:
        self.parent = np.arange(size)

    def link(self, left: np.ndarray, right: np.ndarray) -> None:
        while True:
            a, b = self.parent[left], self.parent[right]
            apart = a != b
            if not apart.any():
                return
            left, right, a, b = left[apart], right[apart], a[apart], b[apart]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))
            while (self.parent != (higher := self.parent[self.parent])).any():
                self.parent = higher
