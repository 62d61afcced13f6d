"""Near copies among vectors, by hashing for the Euclidean distance.

Vectors are brought to length 1, where a cosine fixes a distance. A table hashes
a vector to ``PROJECTIONS`` numbers ``floor((a.x + b) / width)``, ``a`` drawn
from the normal, a 2-stable, distribution; vectors with the same numbers share a
bucket. Within the buckets of all ``TABLES`` the exact cosine decides. Two
vectors that meet in several tables count in the first one alone, which is told
from their hashes, so no pair is ever sent anywhere: a bucket leaves counts and a
forest of links.

Equal vectors are one before hashing. A bucket of more than ``CELL`` vectors is
dealt into parts, and each two parts meet in a task of their own: nothing is
capped and no task holds the bucket.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components link with nothing. Vectors link only with those of as many
components. Rows that repeat an id count as vectors of their own that share a
component; a row without an id counts for others, if it has a sound vector, and
has itself no component and is not kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logbrook.llm.batches import Forest, mixed, stored, whole_groups
from logbrook.llm.components import components

COSINE = 0.95
TABLES = 16
PROJECTIONS = 12
WIDTH = 2.0
SEED = 20250801
CELL = 2048
BLOCK = 1024
"""How many rows of a part are compared at once."""


def near_copies(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE, tables: int = TABLES
) -> DataFrame:
    """``key, n_links, component_id, kept`` per row."""
    rows = stored(_hashed_rows(vectors, key, vector), "vectors")
    sound = rows.where("sound")
    distinct = sound.groupBy("hash", "hash2").agg(
        F.min("id").alias("first"), F.count("*").alias("copies"), F.any_value("vector").alias("vector")
    )
    distinct = stored(distinct, "distinct-vectors")
    met = stored(_compared(distinct, cosine, tables), "met")
    partners = met.groupBy("hash", "hash2").agg(F.sum("n").alias("partners"))
    linked = components(met.where("first <> root"), "first", "root")
    named = distinct.drop("vector").join(partners, ["hash", "hash2"], "left")
    named = named.join(linked, F.col("first") == F.col("node"), "left").select(
        F.col("hash").alias("own"),
        F.col("hash2").alias("own2"),
        (F.coalesce("partners", F.lit(0)) + F.col("copies") - 1).alias("links"),
        F.coalesce("component", "first").alias("component"),
    )
    named = stored(named, "named-vectors")
    on = F.col("sound") & (F.col("hash") == F.col("own")) & (F.col("hash2") == F.col("own2"))
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return rows.drop("vector").join(named.hint("merge"), on, "left").select(
        F.col("id").alias(key),
        F.coalesce("links", F.lit(0).cast("bigint")).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"),
    )


def _hashed_rows(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``id, sound, hash, hash2, vector``: the vector as bytes, and what tells it from others."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [_packed(values) for values in _vectors(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], ["id", "vector"])

    raw = vectors.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    rows = raw.mapInArrow(read, "id bigint, vector binary")
    return rows.select(
        "id",
        F.col("vector").isNotNull().alias("sound"),
        F.xxhash64("vector").alias("hash"),
        F.hash("vector").alias("hash2"),
        "vector",
    )


def _vectors(column: pa.Array) -> list[np.ndarray | None]:
    found: list[np.ndarray | None] = []
    flat, ends = column.flatten(), pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).cumsum()
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64)  # null becomes NaN
    for start, end, known in zip(np.append(0, ends[:-1]), ends, column.is_valid().to_numpy(zero_copy_only=False)):
        found.append(values[start:end] if known else None)
    return found


def _packed(values: np.ndarray | None) -> bytes | None:
    """The bytes of a sound vector; -0.0 is 0.0."""
    if values is None or not len(values) or not np.isfinite(values).all() or not values.any():
        return None
    narrow = values.astype(np.float32) if (np.abs(values) < 1e38).all() else None
    exact = narrow is not None and (narrow == values).all()
    return (b"f" + (narrow + np.float32(0)).tobytes()) if exact else (b"d" + (values + 0.0).tobytes())


def unit_vectors(packed: list[bytes]) -> np.ndarray:
    """Packed vectors of one dimension as rows of length 1, in double precision."""
    rows = [np.frombuffer(data, np.float32 if data[:1] == b"f" else np.float64, offset=1) for data in packed]
    matrix = np.array([row.astype(np.float64) for row in rows])
    matrix /= np.abs(matrix).max(axis=1, keepdims=True)  # so that no square leaves the range of doubles
    return matrix / np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))


def dimension(packed: bytes) -> int:
    return (len(packed) - 1) // (4 if packed[:1] == b"f" else 8)


class Hashes:
    """The quantised projections of all tables, drawn from the seed and the dimension."""

    def __init__(self, size: int, tables: int, projections: int, width: float) -> None:
        draw = np.random.default_rng([SEED, size])
        self.directions = draw.standard_normal((size, tables * projections)) / width
        self.shifts = draw.random(tables * projections)
        self.tables, self.projections, self.size = tables, projections, size

    def buckets(self, units: np.ndarray) -> np.ndarray:
        """One number per vector and table."""
        steps = np.floor(units @ self.directions + self.shifts).astype(np.int64)
        steps = steps.reshape(len(units), self.tables, self.projections).view(np.uint64)
        bucket = np.broadcast_to(mixed(np.arange(self.tables, dtype=np.uint64) + np.uint64(self.size << 16)), steps.shape[:2])
        for at in range(self.projections):
            bucket = mixed(bucket ^ steps[:, :, at])
        return bucket


def _compared(distinct: DataFrame, cosine: float, tables: int) -> DataFrame:
    """``hash, hash2, first, n, root`` per vector and place where it met others."""
    columns = ["hash", "hash2", "first", "copies", "vector"]
    names = ["bucket", "table", *columns]

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = batch.column("vector").to_pylist()
            sizes = np.array([dimension(data) for data in packed])
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                buckets = Hashes(int(size), tables, PROJECTIONS, WIDTH).buckets(unit_vectors([packed[i] for i in at]))
                some = batch.take(pa.array(at))
                for table in range(tables):
                    own = [pa.array(buckets[:, table].view(np.int64)), pa.array(np.full(len(at), table, np.int32))]
                    yield pa.RecordBatch.from_arrays([*own, *some.columns], names)

    shape = "hash bigint, hash2 int, first bigint, copies bigint, vector binary"
    spread_out = distinct.select(columns).mapInArrow(spread, f"bucket bigint, table int, {shape}")
    # Of each bucket with company, its size; those of one vector end here.
    sizes = stored(spread_out.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"), "bucket-sizes")
    parts = F.ceil(F.col("size") / CELL).cast("int")
    part = F.pmod(F.xxhash64("hash", "hash2"), F.col("parts")).cast("int")
    shared = spread_out.join(sizes.withColumnRenamed("bucket", "of").hint("merge"), F.col("bucket") == F.col("of"))
    placed = shared.withColumn("parts", parts).withColumn("part", part)
    cells = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    low, high = F.least("part", "other"), F.greatest("part", "other")
    cells = cells.select(F.xxhash64("bucket", low, high).alias("cell"), "part", (low == high).alias("alone"), "table", *columns)
    dealt = cells.repartition("cell").sortWithinPartitions("cell")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "cell"):
            cell = table.column("cell").to_numpy()
            starts = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
            out = [group_links(table.slice(start, end - start), cosine, tables) for start, end in zip(starts, [*starts[1:], len(cell)]) if end - start > 1]
            out = [group for group in out if group.num_rows]
            if out:
                yield from pa.concat_tables(out).to_batches()

    return dealt.mapInArrow(compare, "hash bigint, hash2 int, first bigint, n bigint, root bigint")


def group_links(group: pa.Table, cosine: float, tables: int) -> pa.Table:
    """What the vectors of a cell have to do with one another: those of one part each with each, else across the two parts."""
    packed = group.column("vector").to_pylist()
    units = unit_vectors(packed)
    table = group.column("table")[0].as_py()
    part, copies = group.column("part").to_numpy(), group.column("copies").to_numpy()
    buckets = Hashes(units.shape[1], tables, PROJECTIONS, WIDTH).buckets(units)[:, :table] if table else None
    everyone = np.arange(len(units))
    alone = group.column("alone")[0].as_py()
    left = everyone if alone else everyone[part == part.min()]
    right = everyone if alone else everyone[part != part.min()]
    forest, n = Forest(len(units)), np.zeros(len(units), np.int64)
    for start in range(0, len(left), BLOCK):
        some = left[start : start + BLOCK]
        a, b = np.nonzero(units[some] @ units[right].T >= cosine)
        a, b = some[a], right[b]
        keep = a < b if alone else np.ones(len(a), bool)
        a, b = a[keep], b[keep]
        if buckets is not None and len(a):
            fresh = np.ones(len(a), bool)
            for earlier in range(table):
                fresh &= buckets[a, earlier] != buckets[b, earlier]
            a, b = a[fresh], b[fresh]
        np.add.at(n, a, copies[b])
        np.add.at(n, b, copies[a])
        forest.link(a, b)
    linked = np.flatnonzero(n)
    first = group.column("first").to_numpy()
    taken = group.select(["hash", "hash2", "first"]).take(pa.array(linked))
    return taken.append_column("n", pa.array(n[linked])).append_column("root", pa.array(first[forest.parent[linked]]))
