"""The streaming queries.

The ``running_`` functions turn streaming DataFrames with the columns of their
batch forms into streaming results, and a sink starts them. State is in RocksDB and in the checkpoint folder: starting again on the
same folder goes on where the query stopped, a new folder reprocesses the log.
``TO_END`` as trigger makes a query end once it has read what is there.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, GroupedData, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import LongType, StructType

from logbrook.functions import parse_long
from logbrook.operators import merge, running_state, word_counts
from logbrook.operators.grouping import complete
from logbrook.plans.rooms import alert, matched, room_log
from logbrook.sources import to_broker
from logbrook.streaming import packed, processors
from logbrook.streaming.processors import (
    ALIGNED_MOVES_SCHEMA,
    FAULTS_SCHEMA,
    MOVES_SCHEMA,
    PIECES,
    ROOMS_SCHEMA,
    AlignedMoves,
    AlignedRooms,
    PackedMoves,
    PackedRooms,
    SeenNumbers,
    place,
)

# Executors get the processors themselves, so that the package need not be installed there.
for module in (packed, processors):
    cloudpickle.register_pickle_by_value(module)

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STORE = "spark.sql.streaming.stateStore.providerClass"

# A micro-batch hands in what it changed; whole copies of the state follow in the background.
CHANGES = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"

# A state partition is a task with a store of its own, and often a Python worker, in each micro-batch, which
# takes most of a second however few rows there are. As micro-batches are bounded, a few for each core will do.
PARTITIONS = "spark.sql.shuffle.partitions"
PER_CORE = 4

# Fixed value: how often counts are passed on, unless another trigger is given.
COMMIT_EVERY = "100 milliseconds"

# After how many micro-batches the table they lead to is written whole.
SNAPSHOT_EVERY = 1000

TO_END = {"availableNow": True}

# Into how many groups the keys of a processor fall by default, hence how many tasks can
# share its work. A checkpoint is tied to its number: another would not find the old states.
BUCKETS = 1024

# Numbers of a topic that one task checks, as a power of two; tied to the checkpoint too.
CHECKED_BITS = 16


@contextmanager
def stateful(spark: SparkSession) -> Iterator[None]:
    """Settings a stateful query takes over when it starts.

    State is kept in RocksDB, in as many partitions as the session shuffles into, but in no
    more than ``PER_CORE`` for each core. A checkpoint keeps the number it began with.
    """
    shuffled = min(int(spark.conf.get(PARTITIONS)), PER_CORE * spark.sparkContext.defaultParallelism)
    settings = {STORE: ROCKSDB, CHANGES: "true", PARTITIONS: str(shuffled)}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def start(writer: DataStreamWriter, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": COMMIT_EVERY})).start()


# --- sinks -------------------------------------------------------------------------------


def start_changes(
    changes: DataFrame,
    out: str,
    checkpoint: str,
    trigger: dict | None = None,
    key: str | None = None,
    value: str | None = None,
    every: int = SNAPSHOT_EVERY,
) -> StreamingQuery:
    """Write a table's changed rows, one folder per micro-batch.

    A batch that is repeated after a failure replaces its folder, so the log of
    changes holds every batch once. Given the table's ``key`` and ``value``, the
    whole table opens a new folder of batches after each ``every`` of them, and a
    head names it once it is complete. Readers list and read the newest of these
    folders only; ``forget_changes`` removes the older ones. ``every`` may differ
    from one start to the next.
    """
    log = ChangeLog(changes.sparkSession, out, changes.schema, key, value, every)
    with stateful(changes.sparkSession):
        return start(changes.writeStream.outputMode("update").foreachBatch(log.write), checkpoint, trigger)


class ChangeLog:
    """The folders of one log of changes, as the query that writes it sees them."""

    def __init__(
        self,
        spark: SparkSession,
        out: str,
        schema: StructType | str,
        key: str | None,
        value: str | None,
        every: int = SNAPSHOT_EVERY,
    ) -> None:
        empty = spark.createDataFrame([], schema)
        empty.write.mode("ignore").parquet(f"{out}/since=-1/batch=-1")
        _add_head(spark, out, -1)
        self.out, self.schema, self.key, self.value, self.every = out, empty.schema, key, value, every
        self.heads = _heads(spark, out)

    def _since(self, number: int) -> int:
        return max(head for head in self.heads if head < number)

    def before(self, spark: SparkSession, number: int) -> DataFrame:
        """The table as the batches before this one left it, also if this one is repeated."""
        return _table(spark, self.out, self._since(number), self.key, self.value, self.schema, number)

    def write(self, batch: DataFrame, number: int) -> None:
        since = self._since(number)
        batch.write.mode("overwrite").parquet(f"{self.out}/since={since}/batch={number}")
        if self.key and self.value and (number + 1) % self.every == 0 and number not in self.heads:
            session = batch.sparkSession
            table = _table(session, self.out, since, self.key, self.value, self.schema)
            table.write.mode("overwrite").parquet(f"{self.out}/since={number}/batch={number}")
            _add_head(session, self.out, number)
            self.heads.append(number)


def latest_changes(spark: SparkSession, out: str, key: str, value: str, schema: str) -> DataFrame:
    """The table that a log of changes leads to: the newest whole table and the batches since."""
    return _table(spark, out, max(_heads(spark, out)), key, value, spark.createDataFrame([], schema).schema)


def forget_changes(spark: SparkSession, out: str) -> list[int]:
    """Remove the folders before the newest whole table, which readers that began earlier may still need; their heads."""
    *old, newest = sorted(_heads(spark, out))
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = path(out).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for head in old:
        for folder in (f"{_heads_of(out)}/upto={head}", f"{out}/since={head}"):
            files.delete(path(folder), True)
    return old


def _heads_of(out: str) -> str:
    return f"{out}-heads"


def _add_head(spark: SparkSession, out: str, number: int) -> None:
    spark.range(1, numPartitions=1).write.mode("ignore").parquet(f"{_heads_of(out)}/upto={number}")


def _heads(spark: SparkSession, out: str) -> list[int]:
    """After which batches the table was written whole; one small file each."""
    heads = spark.read.schema("id bigint, upto bigint").parquet(_heads_of(out))
    return sorted(row.upto for row in heads.select("upto").distinct().collect())


def _table(
    spark: SparkSession, out: str, since: int, key: str, value: str, schema: StructType, before: int | None = None
) -> DataFrame:
    with_batch = StructType([*schema.fields]).add("batch", LongType())
    changes = spark.read.schema(with_batch).parquet(f"{out}/since={since}")
    if before is not None:
        changes = changes.where(F.col("batch") < before)
    return changes.groupBy(key).agg(F.max_by(value, "batch").alias(value))


def start_topic(records: DataFrame, out: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append records to a topic folder, each exactly once."""
    writer = records.writeStream.outputMode("append").format("parquet").option("path", out)
    with stateful(records.sparkSession):
        return start(writer, checkpoint, trigger)


def start_broker(
    rows: DataFrame,
    key: str,
    value: str,
    fmt: str,
    topic: str,
    options: dict[str, str],
    checkpoint: str,
    trigger: dict | None = None,
    mode: str = "append",
) -> StreamingQuery:
    """Send two columns to a broker's topic; tables (counts) need the mode ``update``."""
    writer = to_broker(rows, key, value).writeStream.outputMode(mode).format(fmt).options(topic=topic, **options)
    with stateful(rows.sparkSession):
        return start(writer, checkpoint, trigger)


def copy_lines(lines: DataFrame, out: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Follow text lines and append them to text files."""
    writer = lines.select("value").writeStream.format("text").option("lineSep", "\n").option("path", out)
    return start(writer, checkpoint, trigger)


# --- tables and changelogs ---------------------------------------------------------------


def running_word_counts(lines: DataFrame) -> DataFrame:
    """``word, n``, to be started in update mode."""
    return word_counts(lines)


def running_occupancy(moves: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``room, occupants``, to be started in update mode."""
    return _moves(moves, buckets).groupBy("room").agg(F.sum("delta").alias("occupants"))


def running_occupancy_changelog(moves: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``seq, sub, room, occupants`` after every single change."""
    log = _moves(moves, buckets).withColumns({"moved": F.lit(True), "amount": F.col("delta")}).drop("delta")
    return _rooms(log, buckets).select("seq", "sub", "room", "occupants")


def running_alerts(moves: DataFrame, capacities: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``seq, sub, room, status``: the overflow messages of topics that arrive together, as parts of one log."""
    return alert(matched(_rooms(room_log(_moves(moves, buckets), capacities), buckets)))


def running_alerts_aligned(moves: DataFrame, capacities: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The same for two topics that arrive independently, each in order of ``seq``.

    A row is applied once both topics have passed its ``seq``, whatever the
    micro-batches, so the messages are those of the batch. Messages up to the
    place both have reached are out; to get the last ones of logs that end, close
    both topics (``sources.close_topic``).
    """
    moves, capacities = _placed(moves), _placed(capacities)
    entered = moves.where(_or_none("key IS NOT NULL AND value IS NOT NULL"))
    entered = entered.select("seq", "at", F.col("key").alias("student"), F.col("value").alias("room"))
    deltas = _bucketed(entered, "student", buckets).transformWithStateInPandas(
        AlignedMoves(), ALIGNED_MOVES_SCHEMA, "append", "eventTime", eventTimeColumnName="at"
    )
    changes = deltas.select("seq", "at", "sub", "room", F.lit(True).alias("moved"), F.col("delta").alias("amount"))
    size = parse_long(F.col("value")).alias("amount")
    settings = capacities.select(
        "seq", "at", F.lit(0).alias("sub"), F.col("key").alias("room"), F.lit(False).alias("moved"), size
    ).where(_or_none("room IS NOT NULL AND amount IS NOT NULL"))
    log = _bucketed(merge(changes, settings), "room", buckets)
    return alert(matched(log.transformWithStateInPandas(AlignedRooms(), ROOMS_SCHEMA, "append", "eventTime")))


def running_sequence_check(records: DataFrame, bits: int = CHECKED_BITS) -> DataFrame:
    """Repeats and intervals seen, by topic and block of 2**``bits`` numbers, to be read by ``sequence_faults_so_far``.

    A busy topic is shared by as many tasks as it has blocks in a micro-batch.
    Records without a topic or a number are left out.
    """
    numbered = records.where("topic IS NOT NULL AND seq IS NOT NULL")
    blocks = numbered.select("topic", F.shiftright("seq", bits).alias("block"), "seq").groupBy("topic", "block")
    return blocks.transformWithStateInPandas(SeenNumbers(), FAULTS_SCHEMA, "append", "none")


def sequence_faults_so_far(found: DataFrame) -> DataFrame:
    """``topic, seq, fault, n``: the gaps and repeats that ``operators.sequence_faults`` finds in the same records.

    A gap that a later record fills is none any more.
    """
    repeats = found.where("fault = 'repeat'").groupBy("topic", "seq", "fault").agg(F.sum("n").alias("n"))
    newest = F.max("version").over(Window.partitionBy("topic", "block"))
    seen = found.where("fault = 'seen'").withColumn("newest", newest).where("version = newest")
    linked = running_state(seen, "topic", ["seq"], latest={"until": F.col("n")})
    gap = F.col("seq") - F.col("prev_until") - 1
    gaps = linked.select("topic", "seq", F.lit("gap").alias("fault"), gap.alias("n")).where("n > 0")
    return merge(repeats, gaps)


def _placed(records: DataFrame) -> DataFrame:
    """Records with an offset, and a watermark on it."""
    at = F.timestamp_millis(place(F.col("seq")))
    return records.where("seq IS NOT NULL").withColumn("at", at).withWatermark("at", "0 seconds")


def _or_none(condition: str) -> Column:
    """The condition, in a form that is not pushed below the watermark, which has to see all records."""
    return F.expr(condition) | (F.col("at") < F.timestamp_millis(F.lit(0)))


def _bucketed(rows: DataFrame, key: str, buckets: int) -> GroupedData:
    return _with_bucket(rows, key, buckets).groupBy("bucket")


def _with_bucket(rows: DataFrame, key: str, buckets: int) -> DataFrame:
    return rows.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)))


def _packed(rows: DataFrame, key: str, buckets: int, processor: type) -> GroupedData:
    """The same with the rows in pieces, as a processor's ``INPUT`` has them; an event time does not outlast this."""
    names = processor.INPUT.names
    dealt = _with_bucket(rows, key, buckets).select("bucket", *names)
    pack = packed.packer(processor.INPUT, "bucket", PIECES)
    return dealt.mapInArrow(pack, f"bucket bigint, {PIECES} binary").groupBy("bucket")


def _moves(moves: DataFrame, buckets: int) -> DataFrame:
    entered = complete(moves).select("seq", F.col("key").alias("student"), F.col("value").alias("room"))
    pieces = _packed(entered, "student", buckets, PackedMoves)
    return pieces.transformWithStateInPandas(PackedMoves(), MOVES_SCHEMA, "update", "none")


def _rooms(log: DataFrame, buckets: int) -> DataFrame:
    return _packed(log, "room", buckets, PackedRooms).transformWithStateInPandas(PackedRooms(), ROOMS_SCHEMA, "append", "none")
