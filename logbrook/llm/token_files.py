"""Token ids in binary shards with constant-time access by key.

A shard is two files. ``.ids`` holds the ids of its documents one after the
other, as raw little-endian unsigned numbers, of 16 bits if all ids of the vocabulary have
room in them, else of 32. ``.idx`` holds, behind a
line of JSON that names them, arrays: where each document begins, the keys, and
a minimal perfect hash whose number leads to the key's stored fingerprint and
its first row. Shards follow one another in ascending key order; the table
``manifest`` has their key ranges, and the ids before each.

A shard ends with the document that brings its ids to ``shard_bytes``, however much a
task writes, and is read in ranges of rows. So a reader holds one shard's index and
``READ_IDS`` ids, or one longer document. The manifest, a line for each ``shard_bytes``
of ids, is some 10^-7 of the data and is kept sorted by all that look keys up.

Files are written under a name of their own and then moved, so a repeated or
speculative task replaces a file by its equal. Folders may lie wherever pyarrow's
file systems reach; every executor must see them.

Defined results: a null or empty text is a document of the end id alone. Rows
without a key come first and cannot be looked up; rows that repeat a key are
documents of their own, side by side, and are looked up together. Extra columns
are ignored.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logbrook.llm import perfect_hash
from logbrook.llm.batches import pieces
from logbrook.llm.tokens import Encoder, tokenizer_path

END_ID = 2
SHARD_BYTES = 128 << 20
READ_IDS = 4 << 20
MOST_TASKS = 10_000

# Shards are numbered in key order: the task's number, then that of its shard in these bits.
SHARDS_OF_A_TASK = 20

BOUNDS = "shard bigint, documents bigint, ids bigint, first_key bigint, last_key bigint"


class Piece(NamedTuple):
    """Some documents: their keys, which of these are known, and the ids with each one's number of them."""

    keys: np.ndarray
    known: np.ndarray
    counts: np.ndarray
    ids: np.ndarray


def write(
    documents: DataFrame,
    folder: str,
    key: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    end_id: int = END_ID,
    shard_bytes: int = SHARD_BYTES,
) -> str:
    """Encode the documents into shards in ``folder``, in ascending key order."""
    encoder = Encoder(tokenizer or tokenizer_path())
    kind = "<u2" if max(encoder.size() - 1, end_id) < 1 << 16 else "<u4"
    spark = documents.sparkSession
    rows = documents.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("tie"))
    dealt = rows.repartitionByRange("key", "tie").sortWithinPartitions("key", "tie").select("key", "text")

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[Piece]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                ids, ends = encoder.encode(piece.column(1))
                counts = np.diff(ends, prepend=0) + 1
                data = np.insert(ids, ends, np.uint32(end_id)).astype(kind)
                known = piece.column(0).is_valid().to_numpy(zero_copy_only=False)
                yield Piece(piece.column(0).fill_null(0).to_numpy(zero_copy_only=False), known, counts, data)

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        first = TaskContext.get().partitionId() << SHARDS_OF_A_TASK
        sized = _by_size(encoded(batches), max(1, shard_bytes // np.dtype(kind).itemsize))
        for number, own in groupby(sized, itemgetter(0)):
            line = _write_shard(system, base, first + number, (piece for _, piece in own), kind)
            yield pa.RecordBatch.from_pylist([line], schema=pa.schema([(name, pa.int64()) for name in line]))

    summary = dealt.mapInArrow(shard, BOUNDS)
    # One row per pair of files: that is as many as there were tasks, and one for each ``shard_bytes``.
    found = sorted(summary.collect())
    before, lines = 0, []
    for row in found:
        lines.append((*row, before))
        before += row["ids"]
    spark.createDataFrame(lines, f"{BOUNDS}, ids_before bigint").coalesce(1).write.mode("overwrite").parquet(f"{folder}/manifest")
    return folder


def _by_size(pieces: Iterator[Piece], most: int) -> Iterator[tuple[int, Piece]]:
    """Which shard of the task the documents go to; it ends with the one that brings it to so many ids."""
    shard, held = 0, 0
    for piece in pieces:
        starts, at = np.append(0, np.cumsum(piece.counts)), 0
        while at < len(piece.counts):
            end = min(int(np.searchsorted(starts, starts[at] + most - held)), len(piece.counts))
            yield shard, Piece(piece.keys[at:end], piece.known[at:end], piece.counts[at:end], piece.ids[starts[at] : starts[end]])
            held += int(starts[end] - starts[at])
            at = end
            if held >= most:
                shard, held = shard + 1, 0


def _write_shard(system: fs.FileSystem, base: str, number: int, pieces: Iterator[Piece], kind: str) -> dict[str, int | None]:
    """Both files of a shard; its line of the manifest."""
    keys, known, sizes = [], [], []
    name, draft = f"{base}/shard-{number:012d}", f"{base}/.draft-{uuid.uuid4().hex}"
    with system.open_output_stream(draft) as out:
        for piece in pieces:
            out.write(piece.ids.tobytes())
            keys.append(piece.keys)
            known.append(piece.known)
            sizes.append(piece.counts)
    keys, known, sizes = map(np.concatenate, (keys, known, sizes))
    system.move(draft, f"{name}.ids")
    with system.open_output_stream(f"{draft}x") as out:
        out.write(_to_bytes(_index(keys, known, sizes, np.zeros(0, kind))))
    system.move(f"{draft}x", f"{name}.idx")
    bounds = keys[known]
    return {
        "shard": number,
        "documents": len(keys),
        "ids": int(sizes.sum()),
        "first_key": int(bounds[0]) if len(bounds) else None,
        "last_key": int(bounds[-1]) if len(bounds) else None,
    }


def read(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32``: every document, found by its key in its shard's index."""
    shards = spark.read.parquet(f"{folder}/manifest").select("shard", "ids_before")

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield from _documents(Shard(folder, number), before, with_ids)

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    return shards.repartition(_tasks(shards.count()), "shard").mapInArrow(load, schema)


def _tasks(shards: int) -> int:
    """How many tasks open shards. Their lines are few, so adaptive execution, left alone, would give them all to one."""
    return max(1, min(shards, MOST_TASKS))


def lookup(spark: SparkSession, folder: str, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """``doc_id, ids`` for those of the keys that the files hold; repeated documents give a row each."""
    bounds = spark.read.parquet(f"{folder}/manifest").where("first_key IS NOT NULL").select("shard", "first_key", "last_key")
    numbers, firsts, lasts = np.array(sorted(bounds.collect()), np.int64).reshape(-1, 3).T
    wanted = keys.select(F.col(key).cast("bigint").alias("wanted")).where("wanted IS NOT NULL").distinct()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy()
            # Shards follow one another in key order; rows of one key may go on in the next.
            low, high = np.searchsorted(lasts, own), np.searchsorted(firsts, own, "right")
            times = np.maximum(high - low, 0)
            inside = np.repeat(low - (np.cumsum(times) - times), times) + np.arange(times.sum())
            yield pa.RecordBatch.from_arrays([pa.array(numbers[inside]), pa.array(np.repeat(own, times))], ["shard", "wanted"])

    placed = wanted.mapInArrow(place, "shard bigint, wanted bigint")
    placed = placed.repartition(_tasks(len(numbers)), "shard").sortWithinPartitions("shard")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: Shard | None = None
        for batch in batches:
            shard, own = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for number in np.unique(shard).tolist():
                if opened is None or opened.number != number:
                    opened = Shard(folder, number)
                for wanted in own[shard == number].tolist():
                    rows = [opened.row_ids(row).view(np.int32) for row in opened.rows_of(wanted)]
                    if rows:
                        columns = [pa.array([wanted] * len(rows)), pa.array(rows, pa.list_(pa.int32()))]
                        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids"])

    return placed.mapInArrow(find, "doc_id bigint, ids array<int>")


class Shard:
    """A shard opened for reading: the index in memory, the ids in the file."""

    def __init__(self, folder: str, number: int) -> None:
        self.number = number
        self.system, base = fs.FileSystem.from_uri(folder)
        self.path = f"{base}/shard-{number:012d}"
        with self.system.open_input_stream(f"{self.path}.idx") as file:
            self.index = _from_bytes(file.read())
        self.kind = self.index["ids"].dtype
        self.file = self.system.open_input_file(f"{self.path}.ids")

    def rows_of(self, key: int) -> range:
        """The rows of a key; none if it is not there."""
        first, count = self.rows_of_all(np.array([key]))
        return range(int(first[0]), int(first[0] + count[0]))

    def rows_of_all(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = keys.astype(np.int64).view(np.uint64)
        place = perfect_hash.number(self.index, keys)
        known = place >= 0
        slot = np.where(known, place, 0)
        if not len(self.index["prints"]):
            return slot, np.zeros(len(keys), np.int64)
        known &= self.index["prints"][slot] == perfect_hash.fingerprint(keys)
        return self.index["first_row"][slot], np.where(known, self.index["n_rows"][slot], 0)

    def row_ids(self, row: int) -> np.ndarray:
        return self.ids(*self.index["starts"][row : row + 2].tolist())

    def ids(self, start: int, end: int) -> np.ndarray:
        """Some of the shard's ids, as unsigned 32-bit numbers."""
        width = self.kind.itemsize
        return np.frombuffer(self.file.read_at(width * (end - start), width * start), self.kind).astype("<u4")


def _documents(shard: Shard, before: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    """All rows of a shard: those with a key by looking it up, the others by their places; some at a time."""
    keys, known, starts = (shard.index[name] for name in ("keys", "known", "starts"))
    distinct = np.unique(keys[known])
    first, count = shard.rows_of_all(distinct)
    looked_up = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
    rows = np.concatenate([np.flatnonzero(~known), looked_up]).astype(np.int64)
    own = np.concatenate([np.zeros((~known).sum(), np.int64), np.repeat(distinct, count)])
    # Rows found lie in the order of their keys, as the files do, so some neighbours are one range of ids.
    share = starts[rows] // READ_IDS
    cuts = np.flatnonzero(np.append(True, share[1:] != share[:-1]))
    for some, some_keys in zip(np.split(rows, cuts[1:]), np.split(own, cuts[1:])):
        low, high = int(starts[some].min()), int(starts[some + 1].max())
        ids = shard.ids(low, high)
        spans = list(zip((starts[some] - low).tolist(), (starts[some + 1] - low).tolist()))
        columns = [
            pa.array(some_keys, mask=~known[some]),
            pa.array(starts[some] + before),
            pa.array(starts[some + 1] - starts[some]),
            pa.array([zlib.crc32(ids[start:end]) for start, end in spans], pa.int64()),
        ]
        names = ["doc_id", "start", "n_tokens", "ids_crc32"]
        if with_ids:
            columns.append(pa.array([ids[s:e].view(np.int32) for s, e in spans], pa.list_(pa.int32())))
            names.append("ids")
        yield pa.RecordBatch.from_arrays(columns, names)


def _index(keys: np.ndarray, known: np.ndarray, sizes: np.ndarray, kind: np.ndarray) -> dict[str, np.ndarray]:
    rows = np.flatnonzero(known)
    distinct, at, times = np.unique(keys[rows], return_index=True, return_counts=True)
    hashed = distinct.astype(np.int64).view(np.uint64)
    index = perfect_hash.build(hashed)
    place = perfect_hash.number(index, hashed)
    prints, first_row, n_rows = np.zeros(len(distinct), np.uint32), *np.zeros((2, len(distinct)), np.int64)
    prints[place], first_row[place], n_rows[place] = perfect_hash.fingerprint(hashed), rows[at], times
    own = {"starts": np.append(0, np.cumsum(sizes)), "keys": keys.astype(np.int64), "known": known, "ids": kind}
    return index | own | {"prints": prints, "first_row": first_row, "n_rows": n_rows}


def _to_bytes(arrays: dict[str, np.ndarray]) -> bytes:
    head = [(name, array.dtype.str, array.shape) for name, array in arrays.items()]
    return json.dumps(head).encode() + b"\n" + b"".join(array.tobytes() for array in arrays.values())


def _from_bytes(data: bytes) -> dict[str, np.ndarray]:
    at = data.index(b"\n") + 1
    arrays = {}
    for name, kind, shape in json.loads(data[: at - 1]):
        size = int(np.prod(shape))
        arrays[name] = np.frombuffer(data, kind, size, at).reshape(shape)
        at += size * np.dtype(kind).itemsize
    return arrays
