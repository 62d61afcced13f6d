"""State of many keys held as arrays, and rows handed to a processor as arrays.

A call to the state store costs some hundred microseconds whatever it carries,
so what a bucket of keys knows is packed: a table in pages of some hundred keys,
and waiting rows in runs of some thousand. Spark hands a processor its rows one by
one, at some ten microseconds each, so they come packed too: some thousand to a row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa

# Keys in a page on average, at most.
PAGE = 512

# Rows in a run.
RUN = 4096

# Rows of a task that are dealt to buckets together, and bytes of a bucket's rows in one piece. The pieces
# of one Arrow batch, 10,000 of them if nothing else is set, then stay below the 2 GB that a column of it may have.
DEALT = 1 << 19
PIECE = 1 << 16


class PackedTable:
    """A table from a key to values that are never null, in the state of one bucket.

    The low bits of a key's hash name its page. A table that outgrows its pages
    gets twice as many, so that a call reads and writes each page its keys lie in
    once, and a few keys cost a page each however large the table is.
    """

    def __init__(self, handle, name: str, **values: pa.DataType) -> None:
        self.schema = pa.schema({"key": pa.string(), **values})
        self.pages = handle.getMapState(name, "page int", "rows binary")
        self.extent = handle.getValueState(f"{name}_extent", "depth int, n bigint")

    def find(self, names: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """Marks of the names that are held, and the values; others have zeros or null. Each name comes once."""
        self.depth, self.n = self.extent.get() or (0, 0)
        self.names = names
        self.held = self._read(np.unique(_hashes(names) & ((1 << self.depth) - 1)))
        self.at = pd.Index(self.held["key"]).get_indexer(names)
        values = {
            name: np.append(self.held[name], np.zeros(1, self.held[name].dtype))[self.at] for name in self.schema.names[1:]
        }
        for column in values.values():
            if column.dtype == object:
                column[self.at < 0] = None
        return self.at >= 0, values

    def save(self, **values: np.ndarray) -> None:
        """Values of the names last looked for."""
        found = self.at >= 0
        rows = {"key": np.concatenate([self.held["key"], self.names[~found]])}
        for name, column in values.items():
            rows[name] = np.concatenate([self.held[name], column[~found]])
            rows[name][self.at[found]] = column[found]
        n, depth = self.n + int((~found).sum()), self.depth
        while n > PAGE << depth:
            depth += 1
        if depth > self.depth:
            here = np.unique(_hashes(self.names) & ((1 << self.depth) - 1))
            others = self._read(np.setdiff1d(np.arange(1 << self.depth), here))
            rows = {name: np.concatenate([rows[name], others[name]]) for name in rows}
        page = _hashes(rows["key"]) & ((1 << depth) - 1)
        if depth > self.depth:
            for emptied in np.setdiff1d(np.arange(1 << self.depth), page):
                self.pages.removeKey((int(emptied),))
        order = np.argsort(page, kind="stable")
        columns = [pa.array(rows[field.name][order], field.type) for field in self.schema]
        batch = pa.record_batch(columns, schema=self.schema)
        numbers, starts = np.unique(page[order], return_index=True)
        for number, start, end in zip(numbers, starts, [*starts[1:], len(order)]):
            data = batch.slice(start, end - start).serialize().to_pybytes()
            self.pages.updateValue((int(number),), (data,))
        if (depth, n) != (self.depth, self.n):
            self.extent.update((depth, n))

    def _read(self, numbers: np.ndarray) -> dict[str, np.ndarray]:
        pages = [self.pages.getValue((int(number),)) for number in numbers]
        batches = [pa.ipc.read_record_batch(pa.py_buffer(page[0]), self.schema) for page in pages if page is not None]
        table = pa.Table.from_batches(batches, self.schema)
        return {name: table[name].to_numpy() for name in self.schema.names}


def _hashes(names: np.ndarray) -> np.ndarray:
    return np.array([crc32(name.encode()) for name in names], dtype=np.int64)


class WaitingRows:
    """Rows of several logs that wait for their turn, in the state of one bucket.

    A log's rows come in order, so its runs follow one another, and those that
    are due are whole runs and the beginning of at most one more of each log. New
    rows join a log's last run while that is the smaller one: few rows at a time
    are rewritten a logarithmic number of times and leave no short runs behind.
    The index has one entry for each run, with the rows of it that are gone.
    """

    ENTRY = ("run", "log", "first", "last", "n", "gone")

    def __init__(self, handle, name: str) -> None:
        self.runs = handle.getMapState(name, "run bigint", "rows binary")
        self.entries = handle.getValueState(f"{name}_index", "next bigint, entries binary")

    def add(self, rows: pd.DataFrame, log: str, at: pd.Series) -> int:
        """Keep rows of the logs that a column numbers, with their places; the lowest place that waits now."""
        number, index = self._index()
        for name, part in rows.assign(_place=at.astype("int64")).groupby(log):
            name = int(name)
            while True:
                own = [entry for entry in index if entry["log"] == name]
                tail = max(own, key=lambda entry: entry["last"], default=None)
                if tail is None or tail["n"] - tail["gone"] > len(part) or len(part) >= RUN:
                    break
                part = pd.concat([self._run(tail), part], ignore_index=True)
                self.runs.removeKey((tail["run"],))
                index.remove(tail)
            part = part.sort_values("_place", kind="stable", ignore_index=True)
            for start in range(0, len(part), RUN):
                piece = part.iloc[start : start + RUN]
                first, last = int(piece["_place"].iloc[0]), int(piece["_place"].iloc[-1])
                self.runs.updateValue((number,), (_packed(piece),))
                index.append(dict(zip(self.ENTRY, (number, name, first, last, len(piece), 0))))
                number += 1
        self._store(number, index)
        return min(entry["first"] for entry in index)

    def take(self, reached: int) -> tuple[list[pd.DataFrame], int | None]:
        """Rows at places up to ``reached``, which wait no longer, and the lowest place that still does."""
        number, index = self._index()
        ready = []
        for entry in [entry for entry in index if entry["first"] <= reached]:
            rows = self._run(entry)
            due = int(rows["_place"].searchsorted(reached, "right"))
            ready.append(rows.iloc[:due].drop(columns="_place"))
            if due == len(rows):
                self.runs.removeKey((entry["run"],))
                index.remove(entry)
            else:
                entry["gone"] += due
                entry["first"] = int(rows["_place"].iloc[due])
        self._store(number, index)
        return ready, min((entry["first"] for entry in index), default=None)

    def _run(self, entry: dict[str, int]) -> pd.DataFrame:
        return _unpacked(self.runs.getValue((entry["run"],))[0]).iloc[entry["gone"] :]

    def _index(self) -> tuple[int, list[dict[str, int]]]:
        number, data = self.entries.get() or (0, b"")
        entries = np.frombuffer(data, dtype=np.int64).reshape(-1, len(self.ENTRY))
        return number, [dict(zip(self.ENTRY, entry)) for entry in entries.tolist()]

    def _store(self, number: int, index: list[dict[str, int]]) -> None:
        entries = np.array([[entry[name] for name in self.ENTRY] for entry in index], dtype=np.int64)
        self.entries.update((number, entries.tobytes()))


def _packed(rows: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(rows, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as stream:
        stream.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(data).read_pandas()


def packer(schema: pa.Schema, bucket: str, rows: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Makes record batches that have a bucket besides the schema's columns into one of buckets and pieces of their rows."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= DEALT:
                yield from dealt(held)
                held, n = [], 0
        if n:
            yield from dealt(held)

    def dealt(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        numbers = table[bucket].to_numpy()
        order = np.argsort(numbers, kind="stable")
        columns = table.select(schema.names).cast(schema).take(order).combine_chunks()
        numbers = numbers[order]
        length = max(1, PIECE * len(numbers) // max(1, columns.nbytes))
        found, starts = np.unique(numbers, return_index=True)
        names, pieces, size = [], [], 0
        for number, first, end in zip(found, starts, [*starts[1:], len(numbers)]):
            for start in range(first, end, length):
                (piece,) = columns.slice(start, min(length, end - start)).to_batches()
                pieces.append(piece.serialize().to_pybytes())
                names.append(number)
                size += len(pieces[-1])
                if size >= PIECE * RUN:
                    yield pa.record_batch([pa.array(names, pa.int64()), pa.array(pieces, pa.binary())], names=[bucket, rows])
                    names, pieces, size = [], [], 0
        yield pa.record_batch([pa.array(names, pa.int64()), pa.array(pieces, pa.binary())], names=[bucket, rows])

    return packed


def unpacked(chunks: Iterator[pd.DataFrame], schema: pa.Schema, rows: str) -> Iterator[pd.DataFrame]:
    """The rows of the pieces that a processor was given."""
    for chunk in chunks:
        batches = [pa.ipc.read_record_batch(pa.py_buffer(piece), schema) for piece in chunk[rows]]
        yield pa.Table.from_batches(batches, schema).to_pandas()
