"""State kept per key between micro-batches.

Spark allows no aggregate on top of another aggregate in a stream, so a table
regrouped by its value needs a processor that emits the moves. Keys are grouped
into buckets, each with a packed table from key to state: one call then handles
many keys as arrays, and reads and writes a page of them at a time.

A call sees the rows its keys have in one micro-batch. The source's rate limit
bounds them; they are held as numbers and handed on in slices, so a key with a
large share of a micro-batch stays affordable.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from logbrook.streaming.packed import PackedTable, WaitingRows, unpacked

MOVES_SCHEMA = "seq bigint, sub int, room string, delta bigint"
ALIGNED_MOVES_SCHEMA = f"{MOVES_SCHEMA}, at timestamp"
ROOMS_SCHEMA = (
    "seq bigint, sub int, room string, occupants bigint, size bigint, prev_occupants bigint, prev_size bigint"
)
FAULTS_SCHEMA = "topic string, block bigint, version bigint, fault string, seq bigint, n bigint"
SLICE = 100_000

# The column of packed rows.
PIECES = "pieces"


class Names:
    """Strings as small numbers, in the order they are met."""

    def __init__(self) -> None:
        self.numbers: dict[str, int] = {}

    def number(self, name: str) -> int:
        return self.numbers.setdefault(name, len(self.numbers))

    def column(self, names: pd.Series) -> np.ndarray:
        local, found = pd.factorize(names)
        return np.array([self.number(name) for name in found], dtype=np.int32)[local]

    def all(self) -> np.ndarray:
        return np.array(list(self.numbers), dtype=object)


def _columns(chunks: Iterator[list[np.ndarray]]) -> list[np.ndarray]:
    return [np.concatenate(parts) for parts in zip(*chunks)]


def _ends(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marks of the first and the last row of each run of a sorted key."""
    new = key[1:] != key[:-1]
    return np.append(True, new), np.append(new, True)


def _sliced(columns: dict[str, object]) -> Iterator[pd.DataFrame]:
    for start in range(0, len(columns["seq"]), SLICE):
        yield pd.DataFrame({name: column[start : start + SLICE] for name, column in columns.items()})


class Moves(StatefulProcessor):
    """The room each student is in. A record becomes leave (-1) and enter (+1).

    Takes ``student, seq, room``.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.inside = PackedTable(handle, "rooms", room=pa.string())

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        students, rooms = Names(), Names()
        student, seq, entered = _columns(
            [students.column(chunk["student"]), chunk["seq"].to_numpy(), rooms.column(chunk["room"])] for chunk in rows
        )
        order = np.lexsort((seq, student))
        student, seq, entered = student[order], seq[order], entered[order]
        first, last = _ends(student)

        names = students.all()[student[first]]
        known, held = self.inside.find(names)
        left = np.append(-1, entered[:-1])
        left[first] = [rooms.number(room) if met else -1 for met, room in zip(known, held["room"])]
        places = rooms.all()
        self.inside.save(room=places[entered[last]])

        had = left >= 0
        sub = np.repeat([0, 1], [had.sum(), len(seq)])
        yield from _sliced(
            {
                "seq": np.concatenate([seq[had], seq]),
                "sub": sub,
                "room": places[np.concatenate([left[had], entered])],
                "delta": sub * 2 - 1,
            }
        )

    def close(self) -> None:
        pass


class PackedMoves(Moves):
    """The same with its rows in pieces."""

    INPUT = pa.schema({"student": pa.string(), "seq": pa.int64(), "room": pa.string()})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        return super().handleInputRows(key, unpacked(rows, self.INPUT, PIECES), timerValues)


class AlignedMoves(Moves):
    """The same with each row's place in the order as an event time, for a watermark to go on."""

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for frame in super().handleInputRows(key, rows, timerValues):
            yield frame.assign(at=pd.to_datetime(place(frame["seq"]), unit="ms", utc=True))


class Rooms(StatefulProcessor):
    """Occupants and size of each room, null while unknown, after and before every change.

    Takes ``room, seq, sub, moved, amount``: the amount is a change of occupants
    if ``moved``, else a new size. No column may be null, as 64-bit numbers
    would then reach the arrays as floats.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        numbers = {"occupants": pa.int64(), "size": pa.int64()}
        self.states = PackedTable(handle, "states", **numbers, occupied=pa.bool_(), limited=pa.bool_())

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        rooms = Names()
        room, seq, sub, moved, amount = _columns(
            [rooms.column(chunk["room"]), *(chunk[name].to_numpy() for name in ("seq", "sub", "moved", "amount"))]
            for chunk in rows
        )
        order = np.lexsort((sub, seq, room))
        room, seq, sub, moved, amount = room[order], seq[order], sub[order], moved[order], amount[order]
        first, last = _ends(room)
        start, run = np.flatnonzero(first), np.cumsum(first) - 1
        names = rooms.all()
        _, held = self.states.find(names[room[first]])

        # Running values of a run: the total so far less what it was when the run began.
        def running(step: np.ndarray) -> np.ndarray:
            total = np.cumsum(step)
            return total - (total - step)[start][run]

        change = np.where(moved, amount, 0)
        occupants = running(change) + held["occupants"][run]
        occupied = held["occupied"][run]
        steps = running(moved.astype(np.int64))
        setting = np.maximum.accumulate(np.where(moved, -1, np.arange(len(seq))))
        fresh = setting >= start[run]
        size = np.where(fresh, amount[setting], held["size"][run])
        limited = fresh | held["limited"][run]
        prev_size = np.where(first, held["size"][run], np.roll(size, 1))
        prev_limited = np.where(first, held["limited"][run], np.roll(limited, 1))

        after = {"occupants": occupants, "size": size, "occupied": occupied | (steps > 0), "limited": limited}
        self.states.save(**{name: column[last] for name, column in after.items()})
        state = {
            "occupants": pd.arrays.IntegerArray(occupants, ~after["occupied"]),
            "size": pd.arrays.IntegerArray(size, ~limited),
            "prev_occupants": pd.arrays.IntegerArray(occupants - change, ~(occupied | (steps > moved))),
            "prev_size": pd.arrays.IntegerArray(prev_size, ~prev_limited),
        }
        yield from _sliced({"seq": seq, "sub": sub, "room": names[room], **state})

    def close(self) -> None:
        pass


class PackedRooms(Rooms):
    """The same with its rows in pieces."""

    INPUT = pa.schema(
        {"room": pa.string(), "seq": pa.int64(), "sub": pa.int32(), "moved": pa.bool_(), "amount": pa.int64()}
    )

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        return super().handleInputRows(key, unpacked(rows, self.INPUT, PIECES), timerValues)


class AlignedRooms(Rooms):
    """The same for rows of two topics, each in order, that need not arrive together.

    Rows wait in the state until the watermark, the place both topics have
    reached, has passed them, and are then applied in order. New rows always lie
    beyond the watermark. A bucket has one timer, set to its first waiting row; it
    reads what is due, and little of what is not. What waits is bounded by how far
    one topic is ahead of the other.
    """

    COLUMNS = ["room", "seq", "sub", "moved", "amount"]

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.handle = handle
        self.waiting = WaitingRows(handle, "waiting")
        self.first = handle.getValueState("first", "place bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for chunk in rows:
            self._wake_at(self.waiting.add(chunk[self.COLUMNS], "moved", place(chunk["seq"])))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.first.clear()
        ready, first = self.waiting.take(timerValues.getCurrentWatermarkInMs())
        if first is not None:
            self._wake_at(first)
        if ready:
            yield from super().handleInputRows(key, iter(ready), timerValues)

    def _wake_at(self, first: int) -> None:
        old = self.first.get()
        if old is not None and old[0] <= first:
            return
        if old is not None:
            self.handle.deleteTimer(old[0])
        self.first.update((first,))
        self.handle.registerTimer(first)


class SeenNumbers(StatefulProcessor):
    """Which numbers a topic had within one block of them, as intervals.

    Takes ``seq`` by ``topic, block``. A batch gives a row ``repeat`` for each
    number met before, in it or earlier, with how many times more, and all
    intervals of the block, from ``seq`` to ``n``, under a new version. What is
    kept are the intervals, so a block without holes is two numbers.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("seen", "version bigint, intervals binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        version, data = self.state.get() or (0, b"")
        seen = np.frombuffer(data, dtype=np.int64).reshape(-1, 2)
        met, times = np.unique(np.concatenate([chunk["seq"].to_numpy(np.int64) for chunk in rows]), return_counts=True)
        at = np.searchsorted(seen[:, 0], met, "right") - 1
        known = (at >= 0) & (met <= np.append(seen[:, 1], 0)[at])
        more = times - ~known

        fresh = met[~known]
        starts = np.concatenate([seen[:, 0], fresh])
        order = np.argsort(starts, kind="stable")
        starts, ends = starts[order], np.concatenate([seen[:, 1], fresh])[order]
        apart = starts[1:] != ends[:-1] + 1
        seen = np.stack([starts[np.append(True, apart)], ends[np.append(apart, True)]], axis=1)
        self.state.update((version + 1, seen.tobytes()))

        again = more > 0
        for fault, seq, n in (("repeat", met[again], more[again]), ("seen", seen[:, 0], seen[:, 1])):
            for frame in _sliced({"seq": seq, "n": n}):
                yield frame.assign(topic=key[0], block=key[1], version=version + 1, fault=fault)[FAULTS]

    def close(self) -> None:
        pass


FAULTS = [column.split()[0] for column in FAULTS_SCHEMA.split(", ")]


def place(seq):
    """An offset as an event time in milliseconds. The watermark begins at 0, which must lie before the first row."""
    return seq + 1
