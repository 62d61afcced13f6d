r"""Collocations: phrases that are frequent and whose parts seldom stand without each other.

Frequent phrases are mined as by Toivonen. A sample of the rows proposes phrases
at a lowered threshold, length by length. One pass over all rows then counts, in
the same run, the proposed phrases and their negative border: every phrase that
was not proposed but whose two shorter parts were. All counts of that pass are
exact. If a border phrase turns out frequent, the proposal was too small: what is
frequent joins it, and one more pass counts the whole expansion: the phrases this
newly lets in, those that these let in, and so on to the longest. Then all frequent
phrases are known, with exact counts, whatever the sample was.

The proposal travels as a sieve: one bit for each phrase's hash, out of 32 to 64 a
phrase but at most ``1 << MOST_BITS`` for each size and pass, so what is broadcast
is bounded however many phrases there are. A chance hit lets a phrase be counted
that need not be; none is lost by one.
Counts are combined per piece of text and per task before they are shuffled by
(group, phrase), so a phrase that makes up a third of all rows is one row a task.

Every group (a language, say) is mined on its own; a null group counts as
``und``. Null texts count as empty, empty texts have no words. Repeated rows and
repeated ids count as often as they stand there. Extra columns are ignored.
Ties are broken as ``ranked`` says, so the result is the same on every run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logbrook.llm.batches import filled, map_texts, mixed, stored

LONGEST = 4
SUPPORT = 30
MOST = 2000
SAMPLE_ONE_IN = 8
MOST_BITS = 27
"""16 MB."""
FEWEST_BITS = 15
SPREAD = 512
"""In how many parts a group is ranked before the parts' best are ranked together."""

# Bytes that end a piece of text, and those that end a word inside one.
_BREAKS = np.zeros(256, bool)
_BREAKS[list(b".,;:!?\n\x0b\x0c\r")] = True
_BLANKS = np.zeros(256, bool)
_BLANKS[list(b" \t")] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


class Tokens:
    """The words of many texts, side by side: their number, their piece and their text."""

    def __init__(self, texts: pa.Array) -> None:
        lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        data = np.frombuffer(b"\n".join(pc.cast(filled(texts), pa.binary()).to_pylist()), np.uint8)
        solid = ~(_BREAKS | _BLANKS)[data]
        edge = np.diff(solid.astype(np.int8), prepend=0, append=0)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        # Texts are joined by a break, which ends pieces too.
        breaks = np.flatnonzero(_BREAKS[data])
        self.piece = np.searchsorted(breaks, starts)
        self.text = np.searchsorted(np.cumsum(lengths + 1), starts, side="right")
        offsets = np.zeros(len(starts) + 1, np.int32)
        np.cumsum(ends - starts, out=offsets[1:])
        letters = _LOWER[data[solid]]
        words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(letters))
        coded = words.dictionary_encode()
        self.code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.distinct = coded.dictionary


class Hashes:
    """64-bit hashes of phrases: of a group, then of one word after the other."""

    def __init__(self) -> None:
        self._known: dict[str, int] = {}

    def words(self, words: list[str]) -> np.ndarray:
        known = self._known
        if len(known) > 1 << 17:
            known.clear()
        for word in words:
            if word not in known:
                known[word] = xxhash.xxh64_intdigest(word.encode())
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    def phrases(self, groups: list[str], phrases: list[str]) -> np.ndarray:
        """Whole phrases, words between single blanks."""
        parts = [phrase.split(" ") for phrase in phrases]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        flat = self.words([word for words in parts for word in words])
        starts = np.cumsum(sizes) - sizes
        mix = self.words(groups)
        for step in range(int(sizes.max(initial=0))):
            on = sizes > step
            mix[on] = mixed(mix[on] ^ flat[starts[on] + step])
        return mix


def place(mix: np.ndarray, bits: int) -> np.ndarray:
    """The bit of a hash among ``1 << bits``."""
    return (mix >> np.uint64(64 - bits)).astype(np.int64)


class Sieve:
    """Bitmaps of a set of phrases, some for each size; a bitmap's length is a power of two."""

    def __init__(self, parts: dict[int, list[np.ndarray]]) -> None:
        self.parts = parts

    def holds(self, size: int, mix: np.ndarray) -> np.ndarray:
        held = np.zeros(len(mix), bool)
        for bits in self.parts.get(size, ()):
            at = place(mix, len(bits).bit_length() + 2)
            held |= (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
        return held

    def joined(self, other: Sieve) -> Sieve:
        return Sieve({size: self.parts.get(size, []) + other.parts.get(size, []) for size in {*self.parts, *other.parts}})


def sieve(phrases: DataFrame, most_bits: int = MOST_BITS) -> Sieve:
    """The sieve of ``grp, size, phrase`` rows, which are read twice. The driver gets the bitmaps only."""
    numbers = dict(map(tuple, phrases.groupBy("size").count().collect()))
    bits = {size: min(most_bits, max(FEWEST_BITS, n.bit_length() + 5)) for size, n in numbers.items()}
    hashes = Hashes()

    def set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mix = hashes.phrases(batch.column(0).to_pylist(), batch.column(2).to_pylist())
            sizes = batch.column(1).to_numpy(zero_copy_only=False)
            bit = np.zeros(len(mix), np.int64)
            for size in np.unique(sizes).tolist():
                bit[sizes == size] = place(mix[sizes == size], bits[size]) + 1
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(bit)], ["size", "bit"])

    places = phrases.select("grp", "size", "phrase").mapInArrow(set_bits, "size int, bit bigint")
    packed = places.groupBy("size", F.bitmap_bucket_number("bit").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")
    )
    whole = {size: np.zeros(1 << (bits[size] - 3), np.uint8) for size in numbers}
    for size, bucket, part in packed.collect():  # bits and buckets count from 1
        whole[size][(bucket - 1) * len(part) : bucket * len(part)] = np.frombuffer(part, np.uint8)
    return Sieve({size: [part] for size, part in whole.items()})


def counts(
    documents: DataFrame,
    text: str,
    group: str,
    allowed: Sieve,
    before: Sieve | None,
    sizes: tuple[int, ...],
    least: int = 1,
) -> DataFrame:
    """``grp, size, phrase, n``: exact counts of the phrases of these sizes that are let in, if they are ``least`` or more.

    A phrase is let in if both of its parts that are one word shorter are in
    ``allowed``; single words always are. With ``before`` it is the further pass:
    what that let in is left out, and parts newly let in count as allowed.

    With size 1 comes a row of size 0 and no phrase that counts a group's words.
    Pieces of text are combined before the shuffle, where most phrases are met
    once and a second combining would gain little.
    """
    sieves = documents.sparkSession.sparkContext.broadcast((allowed, before))
    hashes = Hashes()

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        now, then = sieves.value
        return _counted(batch.column(0), filled_groups(batch.column(1)), hashes, now, then, sizes)

    pieces = map_texts(documents.select(text, group), count, "grp string, phrase string, n bigint", text)
    summed = pieces.repartition("grp", "phrase").groupBy("grp", "phrase").agg(F.sum("n").alias("n"))
    size = F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " ")))
    return summed.where((F.col("n") >= least) | (F.col("phrase") == "")).select("grp", size.alias("size"), "phrase", "n")


def filled_groups(groups: pa.Array) -> pa.Array:
    return pc.fill_null(groups.cast(pa.string()), "und")


def _counted(
    texts: pa.Array, groups: pa.Array, hashes: Hashes, now: Sieve, then: Sieve | None, sizes: tuple[int, ...]
) -> pa.RecordBatch:
    tokens = Tokens(texts)
    named = groups.dictionary_encode()
    names = named.dictionary
    group = named.indices.to_numpy(zero_copy_only=False).astype(np.int64)[tokens.text]
    word, width = hashes.words(tokens.distinct.to_pylist()), len(tokens.distinct)
    found: list[tuple[pa.Array, pa.Array, np.ndarray]] = []
    # The first phrases are words: of each distinct one its group, spelling and hash; ``number`` says which stands where.
    key = pa.array(group * width + tokens.code).dictionary_encode()
    number, last = key.indices.to_numpy().astype(np.int64), key.dictionary.to_numpy()
    phrases = [(names.take(pa.array(last // max(1, width))), tokens.distinct.take(pa.array(last % max(1, width))))]
    mix = mixed(hashes.words(names.to_pylist())[last // max(1, width)] ^ word[last % max(1, width)])
    if 1 in sizes:
        total = np.bincount(group, minlength=len(names))
        found.append((names, pa.array([""] * len(names), pa.string()), total))
        found.append((*phrases[0], np.bincount(number, minlength=len(last))))
    at = np.arange(len(tokens.code))
    old = np.full(len(last), then is not None)  # let in before
    for size in range(2, max(sizes) + 1):
        # ``at`` are the places of the phrases let in that are one word shorter; both parts of a longer one must be there,
        # and must have been proposed, or be let in by this pass.
        part = now.holds(size - 1, mix)
        if then is not None:
            part |= ~old
            old = old & then.holds(size - 1, mix)
        inside = part[number]
        ok = np.flatnonzero((at[1:] == at[:-1] + 1) & inside[1:] & inside[:-1])
        ok = ok[tokens.piece[at[ok]] == tokens.piece[at[ok] + size - 1]]
        if not len(ok):
            break
        key = pa.array(number[ok] * width + tokens.code[at[ok] + size - 1]).dictionary_encode()
        head, tail = np.divmod(key.dictionary.to_numpy(), width)
        new_number = key.indices.to_numpy().astype(np.int64)
        first = np.empty(len(head), np.int64)
        first[new_number[::-1]] = ok[::-1]
        old = old[head] & old[number[first + 1]]
        mix = mixed(mix[head] ^ word[tail])
        at, number = at[ok], new_number
        phrases.append((head, tail))
        if size in sizes:
            shown = np.flatnonzero(~old)
            found.append((*_spelled(phrases, tokens.distinct, shown), np.bincount(number, minlength=len(old))[shown]))
    columns = [
        pa.concat_arrays([own for own, _, _ in found] or [names[:0]]),
        pa.concat_arrays([phrase for _, phrase, _ in found] or [tokens.distinct[:0]]),
        pa.array(np.concatenate([n for *_, n in found] or [np.zeros(0, np.int64)]), pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["grp", "phrase", "n"])


def _spelled(phrases: list[tuple], words: pa.Array, shown: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Group and spelling of some of the phrases of a size; each is one a word shorter and a last word."""
    parts = []
    for head, tail in phrases[:0:-1]:
        parts.append(words.take(pa.array(tail[shown])))
        shown = head[shown]
    own, spelled = (column.take(pa.array(shown)) for column in phrases[0])
    return own, pc.binary_join_element_wise(spelled, *parts[::-1], " ")


def frequent(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    group: str = "lang",
    support: int = SUPPORT,
    longest: int = LONGEST,
    sample_one_in: int = SAMPLE_ONE_IN,
    most_bits: int = MOST_BITS,
) -> tuple[DataFrame, DataFrame, int]:
    """All phrases with at least ``support`` occurrences, the words in all of each group, and how many full passes it took.

    ``longest`` is 2 or more.

    The first are ``grp, size, phrase, n``, the second ``grp, total``.
    """
    proposed = _proposal(documents, key, text, group, support, longest, sample_one_in, most_bits)
    sizes = tuple(range(1, longest + 1))
    counted = stored(counts(documents, text, group, proposed, None, sizes, support), "phrase-counts")
    totals = counted.where("size = 0 AND n > 0").select("grp", F.col("n").alias("total"))
    known = counted.where("size > 0")
    failed = stored(_missing(known.where(F.col("size") < longest), proposed), "phrases-missed")
    if failed.isEmpty():
        return known, totals, 1
    # Every phrase this pass lets in counts as proposed within it, so longer ones need no pass of their own:
    # the parts of a frequent phrase are frequent, thus known to be so by now or let in here.
    more = counts(documents, text, group, proposed.joined(sieve(failed, most_bits)), proposed, sizes[1:], support)
    return known.unionByName(stored(more, "phrase-counts")), totals, 2


def _proposal(
    documents: DataFrame, key: str, text: str, group: str, support: int, longest: int, one_in: int, bits: int
) -> Sieve:
    """Phrases frequent in a sample of the rows, all but the longest.

    Rows are chosen by a hash of key and text, so a repeated task chooses the
    same ones; equal rows are chosen together or not at all.
    """
    chosen = documents.where(F.pmod(F.xxhash64(key, text), F.lit(one_in)) == 0).select(text, group)
    sample = stored(chosen, "phrase-sample")
    lowered = support if one_in == 1 else max(2, support // (2 * one_in))
    proposed = Sieve({})
    for size in range(1, longest):
        often = counts(sample, text, group, proposed, None, (size,), lowered).where("size > 0")
        proposed = proposed.joined(sieve(stored(often, "phrases-proposed"), bits))
    return proposed


def _missing(phrases: DataFrame, proposed: Sieve) -> DataFrame:
    """The phrases whose bit is not set."""
    sieves = phrases.sparkSession.sparkContext.broadcast(proposed)
    hashes = Hashes()

    def outside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mix = hashes.phrases(batch.column(0).to_pylist(), batch.column(2).to_pylist())
            sizes = batch.column(1).to_numpy(zero_copy_only=False)
            held = np.zeros(len(mix), bool)
            for size in np.unique(sizes).tolist():
                held[sizes == size] = sieves.value.holds(size, mix[sizes == size])
            yield batch.filter(pa.array(~held))

    columns = phrases.select("grp", "size", "phrase")
    return columns.mapInArrow(outside, columns.schema)


def ranked(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    group: str = "lang",
    support: int = SUPPORT,
    most: int = MOST,
    sample_one_in: int = SAMPLE_ONE_IN,
) -> DataFrame:
    """Each group's first ``most`` collocations: group, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    A phrase of two to four words and ``a`` occurrences is cut where ``a`` over
    the occurrences ``l`` and ``r`` of its parts is lowest; ``score`` is that
    value times 2,000,000, rounded down. One that a longer frequent phrase holds
    in at least four of five cases is left out. Order: score and ``a``
    descending, then the phrase by its bytes.
    """
    phrases, totals, _ = frequent(documents, key, text, group, support, LONGEST, sample_one_in)
    phrases = stored(phrases, "phrases")
    scored = _free(_scored(phrases), phrases)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = Window.partitionBy("grp", F.pmod(F.xxhash64("phrase"), F.lit(SPREAD))).orderBy(*order)
    best = scored.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= most)
    place = F.row_number().over(Window.partitionBy("grp").orderBy(*order)).cast("bigint")
    top = best.withColumn("rank", place).where(F.col("rank") <= most)
    rows = top.join(totals, "grp")
    return rows.select(F.col("grp").alias(group), "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")


def _scored(phrases: DataFrame) -> DataFrame:
    """Candidates with their lowest-scoring cut; of equal ones the earliest."""
    split = F.split("phrase", " ")
    at = F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    cuts = phrases.where("size > 1").select("grp", "phrase", "size", F.col("n").alias("a"), at)
    cuts = cuts.select(
        "grp", "phrase", "size", "a", "k",
        F.array_join(F.slice(split, F.lit(1), F.col("k")), " ").alias("head"),
        F.array_join(F.slice(split, F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("tail"),
    )
    known = phrases.select("grp", "phrase", "n")
    heads = known.withColumnsRenamed({"phrase": "head", "n": "l"})
    tails = known.withColumnsRenamed({"phrase": "tail", "n": "r"})
    met = cuts.join(heads.hint("merge"), ["grp", "head"]).join(tails.hint("merge"), ["grp", "tail"])
    score = F.expr("CAST(CAST(a AS DECIMAL(19, 0)) * 2000000 div (CAST(l AS DECIMAL(19, 0)) + r) AS BIGINT)")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return met.groupBy("grp", "phrase", "size", "a").agg(lowest).select("grp", "phrase", "size", "a", "cut.score", "cut.l", "cut.r")


def _free(scored: DataFrame, phrases: DataFrame) -> DataFrame:
    """Candidates that no longer candidate holds in four of five cases."""
    words = F.split("phrase", " ")
    spans = F.expr("explode(flatten(transform(sequence(2, size - 1), w -> transform(sequence(1, size - w + 1), s -> struct(s, w)))))")
    inner = phrases.where("size > 2").select(words.alias("words"), "grp", "n", spans.alias("span"))
    held = inner.select("grp", F.expr("array_join(slice(words, span.s, span.w), ' ')").alias("phrase"), "n")
    most = held.groupBy("grp", "phrase").agg(F.max("n").alias("held"))
    met = scored.join(most.hint("merge"), ["grp", "phrase"], "left")
    return met.where("held IS NULL OR CAST(held AS DECIMAL(19, 0)) * 100 < CAST(a AS DECIMAL(19, 0)) * 80").drop("held")
