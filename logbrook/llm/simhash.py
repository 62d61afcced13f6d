"""Near copies by SimHash, joined over a binary trie.

A fingerprint is the bitwise majority of the hashes of a text's shingles.
Fingerprints are the leaves of a binary trie; the trie is joined with itself by
walking down pairs of nodes, adding up the bits in which the two paths differ
and leaving a pair as soon as they are too many.

The top of the walk is done by Spark: the nodes at some depth are the tasks'
share, and each distinct fingerprint goes to its own node and to those lower
nodes whose path differs in no more bits than allowed. Nodes that get more than
``GROUP`` fingerprints are divided by going ``STRIDE`` bits deeper, until
none is left. Below that, each group walks its own trie, in blocks of pairs.
Equal fingerprints are one leaf, so copies cost nothing; the links of a group
leave the task as a forest with fewer links than leaves.

Defined results: a null or empty text has fingerprint 0, like any text without
words, and is linked like any other. Rows without an id get a fingerprint and
no component. Rows that repeat an id stay; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logbrook.llm.batches import Forest, filled, free_name, map_texts, stored
from logbrook.llm.components import components

SHINGLE = 3
MAX_BITS = 2
SEED = 42
GROUP = 1 << 18
FIRST_DEPTH, STRIDE = 8, 8
FRONTIER = 1 << 18
"""How many pairs of nodes a task looks at at once."""

BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float64)


def near_copies(
    documents: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """``key, fingerprint (bigint), component_id``: the smallest id reachable over links of at most ``max_bits``."""
    prints = stored(fingerprints(documents, key, text, shingle), "fingerprints")
    leaves = prints.where(F.col(key).isNotNull()).groupBy("fingerprint").agg(F.min(key).alias("first"))
    leaves = stored(leaves, "leaves")
    linked = components(links(leaves, max_bits), "left", "right")
    named = leaves.join(linked, F.col("first") == F.col("node"), "left").select(
        F.col("fingerprint").alias("leaf"), F.coalesce("component", "first").alias("component_id")
    )
    named = stored(named, "components")
    rows = prints.join(named.hint("merge"), F.col("fingerprint") == F.col("leaf"), "left")
    return rows.select(key, "fingerprint", F.when(F.col(key).isNotNull(), F.col("component_id")).alias("component_id"))


def one_of_each(
    documents: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """The documents with only the first of each group, once; rows without an id all stay.

    Of several rows with that first id the one whose text has the lowest hash
    stays, whatever the partitioning; of rows that share that text too, the one
    with the lowest hash of all its columns.
    """
    groups = near_copies(documents, key, text, shingle, max_bits)
    own = free_name(documents, "first_id")
    first = groups.where(F.col(key) == F.col("component_id")).select(F.col(key).alias(own)).distinct()
    first = stored(first, "first-of-group")
    met = documents.join(first.hint("merge"), F.col(key) == F.col(own), "left_semi")
    columns = [F.col(name) for name in documents.columns]
    lowest = F.struct(F.xxhash64(text), F.xxhash64(*columns))
    chosen = met.groupBy(F.col(key).alias(own)).agg(F.min_by(F.struct(*columns), lowest).alias("row")).select("row.*")
    return chosen.unionByName(documents.where(F.col(key).isNull()))


# --- fingerprints ------------------------------------------------------------------------


def fingerprints(documents: DataFrame, key: str, text: str, shingle: int = SHINGLE) -> DataFrame:
    """``key, fingerprint``."""

    def read(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = simhashes(filled(batch.column(1)).to_pylist(), shingle)
        return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(found.view(np.int64))], [key, "fingerprint"])

    rows = documents.select(F.col(key).cast("bigint").alias(key), text)
    return map_texts(rows, read, f"`{key}` bigint, fingerprint bigint", text)


def simhashes(texts: list[str], shingle: int = SHINGLE) -> np.ndarray:
    """The fingerprints of some texts, as unsigned numbers."""
    hashes: list[bytes] = []
    counts = np.zeros(len(texts), np.int64)
    digest = xxhash.xxh64_digest
    for at, value in enumerate(texts):
        words = value.encode().lower().split()  # of bytes: A-Z alone, and exactly the six ASCII blanks
        if not words:
            continue
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.append(0, ends[:-1] + 1)
        width = min(shingle, len(words))
        spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())
        hashes.append(b"".join([digest(joined[start:end], SEED) for start, end in spans]))
        counts[at] = len(words) - width + 1
    return _majority(np.frombuffer(b"".join(hashes), np.uint8).reshape(-1, 8), counts)


def _majority(octets: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per text, the bits set in more than half of its big-endian hashes; counted by byte values, not bit by bit."""
    found = np.zeros(len(counts), np.uint64)
    ends = np.cumsum(counts)
    step = 1024
    for start in range(0, len(counts), step):
        some = counts[start : start + step]
        stop = ends[min(start + step, len(counts)) - 1]
        own = octets[stop - some.sum() : stop]
        owner = np.repeat(np.arange(len(some)) * 256, some)
        for octet in range(8):
            times = np.bincount(owner + own[:, octet], minlength=len(some) * 256).reshape(-1, 256)
            ones = times.astype(np.float64) @ BITS
            packed = np.packbits(2 * ones > some[:, None], axis=1)[:, 0].astype(np.uint64)
            found[start : start + step] |= packed << np.uint64(56 - 8 * octet)
    return found


# --- the walk over pairs of nodes, upper part --------------------------------------------


def links(leaves: DataFrame, max_bits: int = MAX_BITS, group: int = GROUP) -> DataFrame:
    """``left, right``: for each two leaves at most ``max_bits`` apart, a chain of links between their ``first``.

    ``leaves`` has ``fingerprint, first``, fingerprints being distinct.
    """
    found = []
    depth, crowded = FIRST_DEPTH, None
    while True:
        routed = _routed(leaves, depth, max_bits)
        if crowded is not None:
            above = F.shiftrightunsigned("node", STRIDE).alias("above")
            routed = routed.withColumn("above", above).join(crowded, "above", "left_semi").drop("above")
        last = depth >= 64
        if not last:
            loads = routed.groupBy("node").agg(F.count("*").alias("n"), F.max("home").alias("lived_in"))
            heavy = loads.where((F.col("n") > group) & F.col("lived_in"))
            heavy = stored(heavy.select(F.col("node").alias("above")), "crowded-nodes")
            last = heavy.isEmpty()
            if not last:
                light = routed.join(heavy, F.col("node") == F.col("above"), "left_anti")
        found.append(_walked(routed if last else light, max_bits))
        if last:
            break
        depth, crowded = depth + STRIDE, heavy
    union = found[0]
    for more in found[1:]:
        union = union.unionByName(more)
    return union


def _routed(leaves: DataFrame, depth: int, max_bits: int) -> DataFrame:
    """Each leaf at the nodes of a depth where it may meet others: ``node, home, fingerprint, first``."""
    flips = [0]
    for bits in range(1, max_bits + 1):
        flips += [sum(1 << bit for bit in chosen) for chosen in combinations(range(depth), bits)]
    masks = np.array(flips, np.uint64)
    shift = np.uint64(64 - depth)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column(0).to_numpy().view(np.uint64)
            first = batch.column(1).to_numpy()
            step = max(1, (1 << 20) // len(masks))
            for start in range(0, len(prints), step):
                some = prints[start : start + step]
                own = some >> shift
                nodes = own[:, None] ^ masks[None, :]
                row, column = np.nonzero(nodes <= own[:, None])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(nodes[row, column].view(np.int64)),
                        pa.array(column == 0),
                        pa.array(some[row].view(np.int64)),
                        pa.array(first[start : start + step][row]),
                    ],
                    ["node", "home", "fingerprint", "first"],
                )

    schema = "node bigint, home boolean, fingerprint bigint, first bigint"
    return leaves.select("fingerprint", "first").mapInArrow(route, schema)


def _walked(routed: DataFrame, max_bits: int) -> DataFrame:
    def walk(table: pa.Table) -> pa.Table:
        home, prints, first = (table.column(name).to_numpy() for name in ("home", "fingerprint", "first"))
        left, right = group_links(prints.view(np.uint64), first, home, max_bits)
        return pa.table({"left": left, "right": right})

    return routed.groupBy("node").applyInArrow(walk, "left bigint, right bigint")


# --- the walk within a group -------------------------------------------------------------


def group_links(prints: np.ndarray, names: np.ndarray, home: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest of links among the leaves that live at a node, and of visitors to them."""
    nothing = np.zeros(0, np.int64)
    if not home.any() or len(prints) < 2:
        return nothing, nothing
    order = np.lexsort((prints, ~home))
    prints, names = prints[order], names[order]
    n_home = int(home.sum())
    own, visitors = Trie(prints[:n_home]), Trie(prints[n_home:])
    forest = Forest(len(prints))
    for left, right in own.pairs(own, max_bits):
        forest.link(left, right)
    if len(prints) > n_home:
        for left, right in own.pairs(visitors, max_bits):
            forest.link(left, right + n_home)
    tied = np.flatnonzero(forest.parent != np.arange(len(prints)))
    return names[tied], names[forest.parent[tied]]


class Trie:
    """The binary trie of some sorted, distinct numbers, without nodes that have one child.

    A node is a range of the numbers. Its path is as long as what they share.
    """

    def __init__(self, numbers: np.ndarray) -> None:
        n = len(numbers)
        self.numbers = numbers
        size = max(2 * n - 1, 0)
        self.low, self.length = np.zeros(size, np.int64), np.full(size, 64, np.int64)
        self.child = np.full((size, 2), -1, np.int64)
        low, high, ids, used = np.zeros(1, np.int64), np.full(1, n), np.zeros(1, np.int64), 1
        while n and len(ids):
            self.low[ids] = low
            inner = high - low > 1
            low, high, ids = low[inner], high[inner], ids[inner]
            top = _bit_length(numbers[low] ^ numbers[high - 1]) - 1
            self.length[ids] = 63 - top
            shift = top.astype(np.uint64)
            middle = np.searchsorted(numbers, (numbers[high - 1] >> shift) << shift)
            fresh = used + np.arange(2 * len(ids))
            used += len(fresh)
            self.child[ids] = fresh.reshape(2, -1).T
            low, high, ids = np.concatenate([low, middle]), np.concatenate([middle, high]), fresh
        self.key = numbers[self.low] if n else numbers

    def pairs(self, other: Trie, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of the numbers that differ in at most ``max_bits``; of a trie with itself, each two once."""
        if not len(self.key) or not len(other.key):
            return
        same = self is other
        todo = [(np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while todo:
            u, v = todo.pop()
            if len(u) > FRONTIER:
                todo += [(u[FRONTIER:], v[FRONTIER:])]
                u, v = u[:FRONTIER], v[:FRONTIER]
            long_u, long_v = self.length[u], other.length[v]
            shared = np.minimum(long_u, long_v)
            # Paths of no length differ in nothing; a shift by 64 bits is undefined.
            differing = (self.key[u] ^ other.key[v]) >> np.minimum(64 - shared, 63).astype(np.uint64)
            near = (np.bitwise_count(differing) <= max_bits) | (shared == 0)
            u, v, long_u, long_v = u[near], v[near], long_u[near], long_v[near]
            leaves = (long_u == 64) & (long_v == 64)
            ends = leaves & (u != v) if same else leaves
            if ends.any():
                yield self.low[u[ends]], other.low[v[ends]]
            u, v, by_u = u[~leaves], v[~leaves], (long_u <= long_v)[~leaves]
            if same:
                twin = u == v
                inner = self.child[u[twin]]
                both = [(inner[:, 0], inner[:, 0]), (inner[:, 1], inner[:, 1]), (inner[:, 0], inner[:, 1])]
                u, v, by_u = u[~twin], v[~twin], by_u[~twin]
            else:
                both = []
            for side in (0, 1):
                both.append((self.child[u[by_u], side], v[by_u]))
                both.append((u[~by_u], other.child[v[~by_u], side]))
            u, v = (np.concatenate(parts) for parts in zip(*both))
            if len(u):
                todo.append((u, v))


def _bit_length(numbers: np.ndarray) -> np.ndarray:
    """How many bits the numbers need; halves, as doubles hold 53 bits."""
    upper, lower = numbers >> np.uint64(32), numbers & np.uint64(0xFFFFFFFF)
    return np.where(upper > 0, 32 + np.frexp(upper.astype(np.float64))[1], np.frexp(lower.astype(np.float64))[1]).astype(np.int64)
