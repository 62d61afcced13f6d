"""The stream processors and their packed state by themselves, on random micro-batches, against a plain loop."""

import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from logbrook.streaming import packed, processors


class FakeState(dict):
    """A map state, and a value state under one key; counts what is read and written."""

    calls = size = 0

    def _count(self, value):
        self.calls += 1
        self.size += sum(len(part) for part in value or () if isinstance(part, bytes))
        return value

    def getValue(self, key):
        return self._count(dict.get(self, key))

    def updateValue(self, key, value):
        self[key] = self._count(value)

    def removeKey(self, key):
        self._count(self.pop(key, None))

    def get(self):
        return self.getValue(())

    def update(self, value):
        self.updateValue((), value)

    def clear(self):
        self.pop((), None)


class FakeHandle:
    """Stands in for Spark's handle."""

    def __init__(self):
        self.states, self.timers = {}, set()

    def getMapState(self, name, *_):
        return self.states.setdefault(name, FakeState())

    getValueState = getMapState

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)

    @property
    def calls(self):
        return sum(state.calls for state in self.states.values())

    @property
    def size(self):
        return sum(state.size for state in self.states.values())


def run(processor, batches, pick):
    """All output rows, each batch shuffled and cut into chunks."""
    processor.init(FakeHandle())
    found = set()
    for batch in batches:
        batch = batch.sample(frac=1, random_state=pick.randrange(1000))
        chunks = [batch.iloc[start : start + 7] for start in range(0, len(batch), 7)]
        for frame in processor.handleInputRows((0,), iter(chunks), None):
            found |= {tuple(None if pd.isna(value) else value for value in row) for row in frame.itertuples(index=False)}
    return found


@pytest.mark.parametrize("seed", range(5))
def test_moves(seed, monkeypatch):
    monkeypatch.setattr(processors, "SLICE", 4)
    monkeypatch.setattr(packed, "PAGE", 1)
    pick = random.Random(seed)
    log = [(pick.choice("aabc"), seq, pick.choice(["x", "y", "z"])) for seq in range(60)]
    frame = pd.DataFrame(log, columns=["student", "seq", "room"])
    inside, expected = {}, set()
    for student, seq, room in log:
        if student in inside:
            expected.add((seq, 0, inside[student], -1))
        expected.add((seq, 1, room, 1))
        inside[student] = room
    cut = pick.randrange(1, 59)
    for batches in ([frame], [frame[:cut], frame[cut:]]):
        assert run(processors.Moves(), batches, pick) == expected


@pytest.mark.parametrize("seed", range(5))
def test_rooms(seed, monkeypatch):
    monkeypatch.setattr(processors, "SLICE", 4)
    monkeypatch.setattr(packed, "PAGE", 1)
    pick = random.Random(seed)
    log = [
        (pick.choice("AAB"), seq, pick.choice([0, 1]), pick.random() < 0.7, pick.choice([-1, 1, 2**62 + 1]))
        for seq in range(40)
    ]
    frame = pd.DataFrame(log, columns=["room", "seq", "sub", "moved", "amount"])
    frame.loc[frame["moved"], "amount"] = frame.loc[frame["moved"], "amount"].clip(upper=1)
    states, expected = {}, set()
    for room, seq, sub, moved, amount in frame.itertuples(index=False):
        before = states.get(room, (None, None))
        after = ((before[0] or 0) + amount, before[1]) if moved else (before[0], amount)
        states[room] = after
        expected.add((seq, sub, room, *after, *before))
    cut = pick.randrange(1, 39)
    for batches in ([frame], [frame[:cut], frame[cut:]]):
        assert run(processors.Rooms(), batches, pick) == expected


@pytest.mark.parametrize("page", [1, 7, 512])
def test_packed_table_grows_and_is_read_by_pages(page, monkeypatch):
    """Against a dict, over restarts; each page is read and written once a call at most."""
    monkeypatch.setattr(packed, "PAGE", page)
    pick, handle, expected = random.Random(page), FakeHandle(), {}
    for _ in range(40):
        table = packed.PackedTable(handle, "t", n=pa.int64(), text=pa.string(), mark=pa.bool_())
        names = np.array(pick.sample([f"k{i}\u00e9" for i in range(300)] + [""], pick.randrange(1, 30)), dtype=object)
        known, values = table.find(names)
        assert known.tolist() == [name in expected for name in names]
        held = list(zip(*(values[column].tolist() for column in ("n", "text", "mark"))))
        assert held == [expected.get(name, (0, None, False)) for name in names]
        new = [(pick.choice([0, -(2**63), 2**63 - 1]), pick.choice(["", "x"]), pick.random() < 0.5) for _ in names]
        expected |= dict(zip(names, new))
        n, text, mark = zip(*new)
        table.save(n=np.array(n, dtype=np.int64), text=np.array(text, dtype=object), mark=np.array(mark))
    table = packed.PackedTable(handle, "t", n=pa.int64(), text=pa.string(), mark=pa.bool_())
    assert table.find(np.array(list(expected), dtype=object))[0].all()
    assert len(handle.states["t"]) <= max(1, 4 * len(expected) // page)


def test_packed_table_costs_few_calls_for_many_keys_and_little_for_few():
    handle = FakeHandle()
    table = packed.PackedTable(handle, "t", n=pa.int64())
    names = np.array([f"key-{i}" for i in range(100_000)], dtype=object)
    table.find(names)
    table.save(n=np.arange(len(names)))
    handle.states["t"].calls = handle.states["t"].size = 0
    table.find(names)
    assert handle.states["t"].calls <= 2 * len(names) / packed.PAGE
    handle.states["t"].calls = handle.states["t"].size = 0
    table.find(names[:1])
    table.save(n=np.array([5]))
    assert handle.states["t"].calls == 2 and handle.states["t"].size < 100_000


class Reached:
    def __init__(self, at):
        self.at = at

    def getCurrentWatermarkInMs(self):
        return self.at


def aligned(log, batches, pick, run_rows, monkeypatch):
    """All that comes out of rows of two topics, which the watermark lets go in steps."""
    monkeypatch.setattr(packed, "RUN", run_rows)
    processor, handle, found = processors.AlignedRooms(), FakeHandle(), []
    processor.init(handle)
    waiting = {topic: log[log["moved"] == topic] for topic in (True, False)}
    reached = {True: 0, False: 0}
    while any(len(rows) for rows in waiting.values()):
        rows = []
        for topic in waiting:
            take = pick.randrange(batches)
            rows.append(waiting[topic][:take])
            waiting[topic] = waiting[topic][take:]
            reached[topic] = waiting[topic]["seq"].min() if len(waiting[topic]) else log["seq"].max() + 1
        rows = pd.concat(rows)
        if len(rows):
            assert list(processor.handleInputRows((0,), iter([rows.sample(frac=1, random_state=1)]), None)) == []
        watermark = int(min(reached.values()))
        if handle.timers and min(handle.timers) <= watermark:
            handle.timers.clear()
            for frame in processor.handleExpiredTimer((0,), Reached(watermark), None):
                found += [tuple(None if pd.isna(value) else value for value in row) for row in frame.itertuples(index=False)]
        assert len(handle.timers) <= 1
    return found


@pytest.mark.parametrize("seed", range(6))
def test_rows_of_two_topics_wait_in_runs(seed, monkeypatch):
    pick = random.Random(seed)
    log = [(pick.choice("AAB"), seq, 0, pick.random() < 0.7, pick.choice([-1, 1])) for seq in range(200)]
    frame = pd.DataFrame(log, columns=["room", "seq", "sub", "moved", "amount"])
    expected = run(processors.Rooms(), [frame], pick)
    found = aligned(frame, pick.choice([3, 20, 90]), pick, pick.choice([1, 4, 4096]), monkeypatch)
    assert len(found) == len(frame) and set(found) == expected


def test_a_timer_reads_what_is_due_however_much_waits():
    """The same steps with ten times as much of one topic waiting."""
    costs = []
    for ahead in (20_000, 200_000):
        handle = FakeHandle()
        waiting = packed.WaitingRows(handle, "w")
        for start in range(0, ahead, 500):
            seq = np.arange(start, start + 500)
            waiting.add(pd.DataFrame({"seq": seq, "moved": True}), "moved", pd.Series(seq))
        assert len(waiting._index()[1]) <= 2 + ahead / packed.RUN * 2
        state = handle.states["w"]
        state.calls = state.size = 0
        for reached in range(0, 10_000, 100):
            ready, _ = waiting.take(reached)
            assert sum(map(len, ready)) == (1 if reached == 0 else 100)
        costs.append((state.calls, state.size))
    assert costs[0] == costs[1]


@pytest.mark.parametrize("seed", range(8))
def test_seen_numbers(seed):
    """Random numbers in random batches: repeats add up, and the last intervals are the numbers met."""
    pick, handle = random.Random(seed), FakeHandle()
    check, numbers = processors.SeenNumbers(), []
    check.init(handle)
    repeats, seen = {}, []
    for version in range(1, 12):
        batch = [pick.randrange(pick.choice([8, 60])) for _ in range(pick.randrange(1, 12))]
        numbers += batch
        frames = list(check.handleInputRows(("t", 0), iter([pd.DataFrame({"seq": batch})]), None))
        rows = pd.concat(frames)
        assert set(rows["topic"]) == {"t"} and set(rows["version"]) == {version}
        for row in rows[rows["fault"] == "repeat"].itertuples():
            repeats[row.seq] = repeats.get(row.seq, 0) + row.n
        seen = rows[rows["fault"] == "seen"][["seq", "n"]].to_numpy().tolist()
    assert repeats == {number: numbers.count(number) - 1 for number in numbers if numbers.count(number) > 1}
    assert [number for first, last in seen for number in range(first, last + 1)] == sorted(set(numbers))
    assert all(first > last + 1 for (_, last), (first, _) in zip(seen, seen[1:]))


def test_packed_rows_reach_the_processor_whole(monkeypatch):
    """Pieces of any size hold the rows of their bucket and no others; there are far fewer pieces than rows."""
    names = np.array([f"s{n % 50}" for n in range(3000)], dtype=object)
    rows = pa.record_batch(
        {"bucket": np.arange(3000) % 50 % 4, "student": names, "seq": np.arange(3000), "room": names[::-1]}
    )
    schema = processors.PackedMoves.INPUT
    for dealt, size, most in ((1 << 19, 1 << 16, 8), (700, 1 << 16, 20), (1 << 19, 500, 300)):
        monkeypatch.setattr(packed, "DEALT", dealt)
        monkeypatch.setattr(packed, "PIECE", size)
        pieces = [out.to_pandas() for out in packed.packer(schema, "bucket", "pieces")(rows.slice(at, 100) for at in range(0, 3000, 100))]
        pieces = pd.concat(pieces)
        assert len(pieces) <= most
        for bucket, own in pieces.groupby("bucket"):
            found = pd.concat(packed.unpacked(iter([own]), schema, "pieces"))
            expected = rows.to_pandas().query("bucket == @bucket")[schema.names]
            assert sorted(found.itertuples(index=False, name=None)) == sorted(expected.itertuples(index=False, name=None))
    assert list(packed.packer(schema, "bucket", "pieces")(iter([rows.slice(0, 0)]))) == []
