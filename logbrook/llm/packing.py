"""Documents packed into sequences of equal capacity, by best fit and local search.

Pieces are dealt at random into groups of about ``GROUP``. A group packs its
pieces longest first, each where it leaves least room, and then improves what is
underfull: it moves a piece or exchanges one for one, two for one or one for two
between any two bins, always so that the sum of squared fills grows, until
nothing raises it or no packing could do with fewer bins. Bins that are still not full
are opened and their pieces dealt into new, fewer groups, ``ROUNDS`` times in
all, so what a group leaves over is packed with what others leave over. No task
holds more than a group, whatever the number of pieces.

Defined results: a null or empty text is one piece of the end id alone. Rows
without an id or with repeated ids are pieces of their own. Extra columns of
``pack`` go along; ``pieces`` ignores them.
"""

from __future__ import annotations

import bisect
import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logbrook.llm.batches import free_name, map_texts, stored
from logbrook.llm.tokens import Encoder, tokenizer_path

CAPACITY = 4096
END_ID = 1
GROUP = 2048
ROUNDS = 4
FULL = 8
"""A bin with less room than this counts as full."""


def pieces(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids``: documents as ids, the long ones cut."""
    encoder = Encoder(tokenizer or tokenizer_path())
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, ends = encoder.encode(batch.column(1))
        row, piece, start, length, crc, own = [], [], [], [], [], []
        begin = 0
        for at, end in enumerate(ends.tolist()):
            document = np.append(ids[begin:end], np.uint32(end_id)).astype("<u4")
            begin = end
            for number, first in enumerate(range(0, len(document), capacity)):
                part = document[first : first + capacity]
                row.append(at)
                piece.append(number)
                start.append(first)
                length.append(len(part))
                crc.append(zlib.crc32(part.tobytes()))
                if with_ids:
                    own.append(part.view(np.int32))
        columns = [batch.column(0).take(pa.array(row)), pa.array(piece, pa.int32())]
        columns += [pa.array(values, pa.int64()) for values in (start, length, crc)]
        if with_ids:
            columns.append(pa.array(own, pa.list_(pa.int32())))
        return pa.RecordBatch.from_arrays(columns, names + ["ids"] * with_ids)

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    return map_texts(documents.select(F.col(key).cast("bigint").alias("doc_id"), text), cut, schema, text)


def pack(items: DataFrame, length: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """The items with their ``sequence_id`` and ``offset``; each item is no longer than the capacity.

    All other columns go along under their names; ones called ``sequence_id`` or ``offset`` give way to the results.
    """
    items = items.drop("sequence_id", "offset")
    names = _Names(*(free_name(items, name) for name in ("_item", "_group", "_open")))
    left, done = stored(items.withColumn(names.item, F.monotonically_increasing_id()), "packing-items"), []
    for number in range(ROUNDS):
        groups = max(1, -(-left.count() // GROUP))
        dealt = left.withColumn(names.group, F.pmod(F.xxhash64(names.item, F.lit(number)), F.lit(groups)))
        packed = stored(_packed(dealt, names, length, capacity, number, last=number == ROUNDS - 1), "packed")
        if groups == 1:
            done.append(packed.drop(names.item, names.open))
            break
        done.append(packed.where(~F.col(names.open)).drop(names.item, names.open))
        left = packed.where(names.open).drop(names.open, "sequence_id", "offset")
    union = done[0]
    for more in done[1:]:
        union = union.unionByName(more)
    return union


class _Names(NamedTuple):
    """Columns used on the way, called as no column of the items is."""

    item: str
    group: str
    open: str


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids``: packed pieces joined to whole sequences."""
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten("parts.ids").alias("ids"))


def _packed(dealt: DataFrame, names: _Names, length: str, capacity: int, number: int, last: bool) -> DataFrame:
    added = T.StructType.fromDDL(f"sequence_id bigint, offset bigint, `{names.open}` boolean")
    schema = T.StructType(dealt.drop(names.group).schema.fields + added.fields)

    def place(key: tuple, table: pa.Table) -> pa.Table:
        lengths = table.column(length).to_numpy()
        bins = packed_bins(lengths.tolist(), capacity)
        sequence, offset, is_open = np.empty((3, len(lengths)), np.int64)
        base = (number << 56) + (key[0].as_py() << 20)
        for at, items in enumerate(bins):
            own = lengths[items]
            sequence[items] = base + at
            offset[items] = np.cumsum(own) - own
            is_open[items] = not last and capacity - own.sum() >= FULL
        table = table.drop_columns([names.group])
        for name, values in (("sequence_id", sequence), ("offset", offset), (names.open, is_open.astype(bool))):
            table = table.append_column(name, pa.array(values))
        return table

    return dealt.groupBy(names.group).applyInArrow(place, schema)


def packed_bins(lengths: list[int], capacity: int) -> list[list[int]]:
    """Items, by number, in bins no fuller than the capacity."""
    order = sorted(range(len(lengths)), key=lambda item: (-lengths[item], item))
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []  # (room, bin), sorted
    for item in order:
        at = bisect.bisect_left(room, (lengths[item], -1))
        free, target = room.pop(at) if at < len(room) else (capacity, len(bins))
        if target == len(bins):
            bins.append([])
        bins[target].append(item)
        if free > lengths[item]:
            bisect.insort(room, (free - lengths[item], target))
    return improved(bins, lengths, capacity)


class Bin:
    """Items by length, and what an exchange may take out of them: one or two, told by their lengths only."""

    def __init__(self, items: list[int], lengths: list[int]) -> None:
        self.items: dict[int, list[int]] = {}
        for item in items:
            self.items.setdefault(lengths[item], []).append(item)
        self._measure()

    def _measure(self) -> None:
        self.fill = sum(length * len(own) for length, own in self.items.items())
        self.one = np.array(sorted(self.items), np.int64)
        twice = np.array([len(self.items[length]) > 1 for length in self.one.tolist()], bool)
        first, second = np.triu_indices(len(self.one))
        able = (first != second) | twice[first]
        self.two = self.one[first[able]] + self.one[second[able]]
        self.two_parts = first[able], second[able]

    def taken(self, weights: list[int]) -> list[int]:
        """Items of these lengths, taken out."""
        out = []
        for weight in weights:
            own = self.items[weight]
            out.append(own.pop())
            if not own:
                del self.items[weight]
        return out

    def given(self, items: list[int], weights: list[int]) -> None:
        for item, weight in zip(items, weights):
            self.items.setdefault(weight, []).append(item)
        self._measure()

    def parts(self, option: int) -> list[int]:
        """The lengths behind an option: none, then each one, then each two."""
        if option == 0:
            return []
        if option <= len(self.one):
            return [int(self.one[option - 1])]
        first, second = (side[option - 1 - len(self.one)] for side in self.two_parts)
        return [int(self.one[first]), int(self.one[second])]


def improved(bins: list[list[int]], lengths: list[int], capacity: int) -> list[list[int]]:
    """The same items in at most as many bins, the sum of squared fills raised until no step raises it.

    Steps are a move, and exchanges of one for one, two for one and one for two.
    Two bins are looked at together only if one of them has changed since. The
    search also ends once no packing could do with fewer bins.
    """
    own = [Bin(items, lengths) for items in bins]
    fewest = -(-sum(lengths) // capacity)
    changed, checked, clock = np.zeros(len(own), np.int64), np.full(len(own), -1), 0
    live = sum(bool(one.fill) for one in own)
    helped = True
    while helped and live > fewest:
        helped = False
        for giver in sorted(range(len(own)), key=lambda at: own[at].fill):
            while 0 < own[giver].fill < capacity and live > fewest:
                fresh = changed > checked[giver] if changed[giver] <= checked[giver] else np.ones(len(own), bool)
                takers = [at for at in np.flatnonzero(fresh).tolist() if at != giver and 0 < own[at].fill < capacity]
                step = _best_step(own[giver], [own[at] for at in takers], capacity)
                if step is None:
                    break
                number, out, back = step
                taker = takers[number]
                moved, returned = own[giver].taken(out), own[taker].taken(back)
                own[giver].given(returned, back)
                own[taker].given(moved, out)
                clock += 1
                changed[giver] = changed[taker] = clock
                live -= not own[giver].fill
                helped = True
            checked[giver] = clock
    return [[item for some in one.items.values() for item in some] for one in own if one.fill]


def _best_step(giver: Bin, takers: list[Bin], capacity: int) -> tuple[int, list[int], list[int]] | None:
    """Which taker, what it gets and what it gives back, so that the squared fills grow most; None if nothing raises them."""
    if not takers:
        return None
    sizes = [1 + len(bin.one) + len(bin.two) for bin in takers]
    starts = np.cumsum([0, *sizes])
    back = np.concatenate([part for bin in takers for part in (_NONE, bin.one, bin.two)])
    fill = np.repeat([bin.fill for bin in takers], sizes)
    few = np.zeros(len(back), bool)  # two are exchanged for one only
    for start, bin in zip(starts.tolist(), takers):
        few[start + 1 : start + 1 + len(bin.one)] = True
    best, chosen = 0, None
    for out, against, skipped in ((giver.one, np.arange(len(back)), 1), (giver.two, np.flatnonzero(few), 1 + len(giver.one))):
        rows = max(1, CELLS // max(1, len(against)))
        for low in range(0, len(out), rows):
            more = out[low : low + rows, None] - back[against]
            gain = more * (fill[against] + more - giver.fill)
            gain[(more <= 0) | (fill[against] + more > capacity)] = 0
            if gain.size and (top := int(gain.max())) > best:
                row, column = divmod(int(gain.argmax()), gain.shape[1])
                best, chosen = top, (skipped + low + row, int(against[column]))
    if chosen is None:
        return None
    out, option = chosen
    number = int(np.searchsorted(starts, option, side="right")) - 1
    return number, giver.parts(out), takers[number].parts(option - int(starts[number]))


_NONE = np.zeros(1, np.int64)
CELLS = 1 << 20
"""How many exchanges are compared at once."""
