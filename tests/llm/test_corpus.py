"""The corpus operators against brute force, on rows that are null, empty, long, repeated or oddly named."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F

from logbrook.llm import archives, components, embeddings, licenses, packing, perfect_hash, quality, queries, sampling, secret_scan, simhash, token_files, tokens, toxicity
from logbrook.llm.automaton import compiled
from logbrook.session import work_dir

FOLDER = "/root/testdata/sf0.001"
BLANKS = r"[^\x20\x09-\x0D]+"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, fingerprint string, component_id int, score int, node int, length int, offset int, sequence_id int, kept int, first int"


def rows_of(texts, first_id=0):
    extra = ("en", "src0", 5, "f", 1, 2, 3, 4, 5, 6, 7, 8)
    return [(None if number is None else number + first_id, text, *extra) for number, text in texts]


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(4)
    words = ["alpha", "Beta", "gamma,", "delta", "é", "日本", "naïve.", "x", "#tag", "a|b", "token=abcdefgh12", "\n", "don't"]
    texts = [None, "", "   ", "a", "a b", "A  b", "one two three", "One two\tthree", "ab " * 70_000, "same text here again", "same text here again"]
    texts += [" ".join(rng.choice(words) for _ in range(rng.randint(1, 90))) for _ in range(60)]
    numbered = list(enumerate(texts)) + [(3, "a"), (3, "a"), (None, "no id"), (None, None), (9, "same text here again")]
    return spark.createDataFrame(rows_of(numbered), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def collected(frame):
    return [tuple(row) for row in frame.collect()]


def plain_rows(frame):
    return [(row["doc_id"], row["text"] or "") for row in frame.collect()]


# --- SimHash -----------------------------------------------------------------------------


def brute_print(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(BLANKS, lowered)
    shingles = [" ".join(words[at : at + 3]) for at in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(shingle.encode(), 42) for shingle in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute_components(ids, near):
    group = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in near:
            low = min(group[a], group[b])
            changed |= group[a] != low or group[b] != low
            group[a] = group[b] = low
    return group


def test_simhash_equals_brute_force(odd, nothing):
    found = collected(simhash.near_copies(odd))
    texts = plain_rows(odd)
    assert sorted((str(i), f) for i, f, _ in found) == sorted((str(i), np.uint64(brute_print(t)).astype(np.int64)) for i, t in texts)
    prints = collections.defaultdict(set)
    for i, t in texts:
        if i is not None:
            prints[i].add(brute_print(t))
    pairs = [(a, b) for a, b in itertools.combinations(prints, 2) if any((x ^ y).bit_count() <= 2 for x in prints[a] for y in prints[b])]
    expected = brute_components(list(prints), pairs)
    assert {i: c for i, _, c in found if i is not None} == expected
    assert all(c is None for i, _, c in found if i is None)
    assert collected(simhash.near_copies(nothing)) == []
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(set(expected.values()))
    assert kept.where("doc_id IS NULL").count() == 2


@pytest.mark.parametrize("group", [simhash.GROUP, 40, 4])
def test_trie_join_divides_crowded_nodes(spark, group):
    rng = random.Random(1)
    numbers = {0, 1, 3, 2**64 - 1, 2**63}
    for _ in range(12):
        base = rng.getrandbits(64)
        numbers |= {base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(15)}
    centre = rng.getrandbits(64)  # one dense ball
    numbers |= {centre ^ (1 << a) ^ (1 << b) for a in range(40, 52) for b in range(12)}
    ordered = sorted(numbers)
    rows = [(int(np.uint64(n).astype(np.int64)), at) for at, n in enumerate(ordered)]
    leaves = spark.createDataFrame(rows, "fingerprint bigint, first bigint")
    links = collected(simhash.links(leaves, 2, group))
    pairs = [(a, b) for a, b in itertools.combinations(range(len(ordered)), 2) if (ordered[a] ^ ordered[b]).bit_count() <= 2]
    assert brute_components(range(len(ordered)), links) == brute_components(range(len(ordered)), pairs)


def test_trie_pairs_are_exact():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**64, 20, dtype=np.uint64)
    numbers = np.unique(np.concatenate([base, base ^ np.uint64(5), base ^ np.uint64(1 << 40)]))
    trie = simhash.Trie(numbers)
    found = {tuple(sorted(p)) for a, b in trie.pairs(trie, 2) for p in zip(a.tolist(), b.tolist())}
    near = np.bitwise_count(numbers[:, None] ^ numbers[None, :]) <= 2
    assert found == {(a, b) for a, b in zip(*map(np.ndarray.tolist, np.nonzero(near))) if a < b}


def test_components_of_chains_rings_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(500, i) for i in range(501, 700)] + [(9, 8), (8, 7), (7, 9), (5, 5), (None, 3)]
    found = dict(collected(components.components(spark.createDataFrame(links, "left bigint, right bigint"))))
    expected = {i: 100 for i in range(100, 141)} | {i: 500 for i in range(500, 700)} | {7: 7, 8: 7, 9: 7}
    assert found == expected
    assert collected(components.components(spark.createDataFrame([], "left bigint, right bigint"))) == []


# --- embeddings --------------------------------------------------------------------------


def test_embeddings_equal_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((12, 16))
    vectors = [b + 0.05 * rng.standard_normal(16) for b in base for _ in range(12)]
    vectors += [vectors[0].copy(), 3 * vectors[0], vectors[1].copy(), vectors[1].copy()]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors)]
    bad = [None, [], [0.0] * 16, [float("nan")] * 16, [1.0, None] * 8, [float("inf")] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0]]
    rows += [(1000 + i, v, 1) for i, v in enumerate(bad)] + [(None, vectors[2].tolist(), 1)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, n_links int")
    monkeypatch.setattr(embeddings, "CELL", 8)  # buckets are dealt into parts
    found = collected(embeddings.near_copies(frame))
    sound = {i: np.array(v) for i, v, _ in rows if i is not None and (i < 1000 or i >= 1006)}
    near, exact = [], collections.Counter()
    for a, b in itertools.combinations(sound, 2):
        x, y = sound[a], sound[b]
        if len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.95:
            near.append((a, b))
            exact.update([a, b])
    null_twin = {a for a in sound if len(sound[a]) == 16 and sound[a] @ vectors[2] / np.sqrt((sound[a] @ sound[a]) * (vectors[2] @ vectors[2])) >= 0.95}
    exact.update(null_twin)
    counts = {i: n for i, n, _, _ in found if i is not None}
    assert all(counts[i] <= exact[i] for i in sound)
    assert sum(counts.values()) >= 0.9 * sum(exact.values())
    group = brute_components([i for i, _, _ in rows if i is not None], near)
    assert {i: c for i, _, c, _ in found if i is not None} == group
    assert all(kept == (i == c) for i, _, c, kept in found if i is not None)
    assert [(i, c, k) for i, _, c, k in found if i is None] == [(None, None, False)]
    assert all(counts[1000 + i] == 0 for i in range(6))
    assert collected(embeddings.near_copies(frame.limit(0))) == []


# --- secrets -----------------------------------------------------------------------------

EXPECTED = {
    "assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
    "access": re.compile("AKIA[A-Z0-9]+"),
    "hex": re.compile("[0-9a-f]+"),
}


def brute_secrets(text):
    long_enough = {"assign": lambda m: len(m[2]) >= 8, "access": lambda m: len(m[0]) >= 16, "hex": lambda m: len(m[0]) >= 32}
    kinds = list(EXPECTED)
    return sorted((m.start(), kinds.index(k), m.end()) for k, rx in EXPECTED.items() for m in rx.finditer(text) if long_enough[k](m))


def test_secrets_equal_regular_expressions(odd, nothing):
    scanner, rng = secret_scan.Scanner(), random.Random(5)
    parts = ["password", "passwd", "SECRET", "Token", "apikey", "api_key", "=", ":", " ", '"', "'", "abc", "0123456789abcdef", "é", "AKIA", "ABCDEFGH1234", "x", "\n", "aaaaaaaaaa", "ffff0000ffff0000", "-", "ghp_", "eyJ", "."]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 14)))
        assert [s for s in secret_scan.character_spans(scanner, text) if s[1] < 3] == brute_secrets(text), text
    found = secret_scan.found(odd).collect()
    assert len(found) == odd.count()
    texts = collections.Counter(plain_rows(odd))
    for row in found:
        spans = brute_secrets(next(t for i, t in texts if i == row["doc_id"] and hashlib.sha256(",".join(f"{list(EXPECTED)[k]}:{s}:{e}" for s, k, e in brute_secrets(t)).encode()).hexdigest() == row["base_sha256"]))
        assert [row["n_assign"], row["n_access"], row["n_hex"]] == [sum(k == kind for _, k, _ in spans) for kind in range(3)]
    assert collected(secret_scan.found(nothing)) == []


def test_further_kinds_and_masks(spark):
    text = "é -----BEGIN RSA PRIVATE KEY----- ghp_" + "a1B2" * 9 + " token: abcdefgh12345"
    frame = spark.createDataFrame([(1, text, len(text)), (2, None, None), (3, "clean", 99)], "doc_id bigint, text string, n_chars bigint")
    row = secret_scan.found(frame).where("doc_id = 1").first()
    assert [span.split(":")[0] for span in row["spans"].split(",")] == ["private_key", "forge_token", "assign"]
    masked = {r["doc_id"]: (r["text"], r["n_chars"]) for r in secret_scan.masked(frame).collect()}
    assert masked == {1: ("é [secret] [secret] [secret]", 28), 2: (None, None), 3: ("clean", 99)}


@pytest.mark.parametrize("pattern", ["a(b|c)*d", "a{2,3}b", "[^a]x?", "(ab){2,}", "a+b*c?", r"\x61\.", "(a|ab)(c|bcd)"])
def test_automaton_matches_like_re(pattern):
    automaton, back = compiled([(pattern, False)], search=False), compiled([(pattern, False)], search=False, backwards=True)
    for size in range(1, 6):
        for letters in itertools.product(b"abcdx.", repeat=size):
            for machine, order in ((automaton, letters), (back, letters[::-1])):
                state = 0
                for byte in order:
                    state = machine.step[state, machine.byte_class[byte]]
                assert bool(machine.accepts[state]) == bool(re.fullmatch(pattern, bytes(letters).decode()))


# --- quality -----------------------------------------------------------------------------


def test_quality_equals_brute_force(odd, nothing):
    found = collections.Counter(tuple(row)[:9] for row in quality.verdicts(odd).collect())
    expected = collections.Counter()
    for i, text in plain_rows(odd):
        words = re.findall(BLANKS, text)
        windows = collections.Counter(zip(words, words[1:], words[2:]))
        covered = {at + step for at in range(len(words) - 2) if windows[tuple(words[at : at + 3])] > 1 for step in range(3)}
        lines = [line for line in text.split("\n") if re.search(BLANKS, line)]
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        data = text.encode()
        kept = not failed
        if data:
            packed = zstandard.ZstdCompressor(level=3).compress
            kept &= quality.within_band(len(data), len(packed(data)) / len(data))
            starts = [*range(0, len(data) - 4095, 4096), *([len(data) - 4096] if len(data) % 4096 else [])]
            chunks = [data[at : at + 4096] for at in starts] if len(data) > 4096 else []
            kept &= sum(not quality.within_band(4096, len(packed(c)) / 4096) for c in chunks) <= 0.3 * len(chunks)
        symbols = len(re.findall(r"[#*$%&|<>]", text))
        expected[(i, len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed, kept)] += 1
    assert collections.Counter({key[:8]: 0 for key in found}).keys() == expected.keys()
    assert quality.verdicts(odd).count() == odd.count()
    assert quality.kept(odd).columns == odd.columns
    assert collected(quality.verdicts(nothing)) == []


# --- tokens, packing, files --------------------------------------------------------------


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.tokenizer_path())


def test_word_wise_ids_are_the_library_s(whole):
    rng = random.Random(3)
    parts = ["a", "The ", "İx", "é", "É", "<|endoftext|>", "'s", "'", "12", "...", " ", "\x85", "\x1c", "\n", "ß", "Σ", "日本", "😀", "don't,", "x.y", "ſ", "ª", "Ñandú,", "&&&"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(4000)]
    ids, ends = tokens.Encoder(tokens.tokenizer_path()).encode(pa.array([*texts, None]))
    begin = 0
    for text, end in zip(texts, ends.tolist()):
        assert ids[begin:end].tolist() == whole.encode(text, add_special_tokens=False).ids, text
        begin = end
    assert ends[-1] == ends[-2]


def test_packing(spark, odd, nothing, whole):
    pieces = packing.pieces(odd, with_ids=True)
    packed = packing.pack(pieces).collect()
    ids = {(r["doc_id"], r["piece"], r["ids_crc32"]): list(r["ids"]) for r in packed}
    expected = collections.Counter()
    for i, text in plain_rows(odd):
        own = whole.encode(text, add_special_tokens=False).ids + [1]
        for number, start in enumerate(range(0, len(own), 4096)):
            part = own[start : start + 4096]
            expected[(i, number, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed) == expected
    assert all(zlib.crc32(np.array(own, "<u4").tobytes()) == crc for (_, _, crc), own in ids.items())
    sequences = collections.defaultdict(list)
    for row in packed:
        sequences[row["sequence_id"]].append((row["offset"], row["length"]))
    for own in sequences.values():
        own.sort()
        assert [offset for offset, _ in own] == [0, *itertools.accumulate(length for _, length in own)][:-1]
        assert sum(length for _, length in own) <= 4096
    assert len(sequences) == -(-sum(row["length"] for row in packed) // 4096)
    joined = packing.sequences(packing.pack(pieces)).collect()
    assert sum(len(r["ids"]) for r in joined) == sum(row["length"] for row in packed)
    assert collected(packing.pack(packing.pieces(nothing))) == []


def test_local_search_saves_bins_and_several_groups_meet(spark, monkeypatch):
    # Best fit puts 6 and 3 together; only exchanges reach three full bins.
    lengths = [6, 3, 4, 4, 2, 5, 3, 3]
    bins = packing.packed_bins(lengths, 10)
    assert len(bins) == 3 and sorted(sum(bins, [])) == list(range(8))
    monkeypatch.setattr(packing, "GROUP", 50)
    rng = random.Random(2)
    items = [(i, rng.randint(1, 1500)) for i in range(1500)]
    packed = packing.pack(spark.createDataFrame(items, "name int, length bigint")).collect()
    assert sorted((r["name"], r["length"]) for r in packed) == sorted(items)
    fills = collections.Counter()
    for row in packed:
        fills[row["sequence_id"]] += row["length"]
    assert max(fills.values()) <= 4096 and len(fills) <= 1.02 * sum(length for _, length in items) / 4096 + 1


def test_token_files(spark, odd, nothing, whole):
    folder = token_files.write(odd, work_dir(spark, "token-files"))
    found = token_files.read(spark, folder, with_ids=True).collect()
    assert len(found) == odd.count()
    expected = collections.Counter((i, tuple(whole.encode(t, add_special_tokens=False).ids + [2])) for i, t in plain_rows(odd))
    assert collections.Counter((r["doc_id"], tuple(r["ids"])) for r in found) == expected
    found.sort(key=lambda r: r["start"])
    keys = [-1 if r["doc_id"] is None else r["doc_id"] for r in found]
    assert keys == sorted(keys)
    assert [r["start"] for r in found] == [0, *itertools.accumulate(r["n_tokens"] for r in found)][:-1]
    assert all(r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in found)
    wanted = spark.createDataFrame([(3,), (4,), (99_999,), (None,)], "doc_id bigint")
    looked_up = collections.Counter(r["doc_id"] for r in token_files.lookup(spark, folder, wanted).collect())
    assert looked_up == {3: 3, 4: 1}
    empty = token_files.write(nothing, work_dir(spark, "token-files"))
    assert collected(token_files.read(spark, empty)) == []


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(0).integers(0, 2**64, 20_000, dtype=np.uint64))
    index = perfect_hash.build(keys)
    assert sorted(perfect_hash.number(index, keys).tolist()) == list(range(len(keys)))
    assert index["words"].nbytes * 8 < 4 * len(keys)
    assert len(perfect_hash.build(keys[:0])["words"]) == 0


# --- sampled pieces ----------------------------------------------------------------------


def test_sampling_is_lossless_and_reproducible(odd, nothing):
    encoded = sampling.encode(odd)
    assert sorted(map(str, collected(sampling.decode(encoded)))) == sorted(str(row) for row in plain_rows(odd))
    assert sorted(map(str, collected(encoded))) == sorted(map(str, collected(sampling.encode(odd.repartition(7)))))
    other = sampling.encode(odd, seed=8)
    assert sorted(map(str, collected(encoded))) != sorted(map(str, collected(other)))
    hashes = collections.Counter(r["text_sha256"] for r in sampling.digests(odd).collect())
    assert hashes == collections.Counter(hashlib.sha256(t.encode()).hexdigest() for _, t in plain_rows(odd))
    assert collected(sampling.encode(nothing)) == []


def test_samples_follow_the_lattice(tmp_path):
    vocabulary = sampling.Vocabulary(tokens.tokenizer_path(sampling.MODEL)).load()
    weights = {}

    def ways(rest, ids, weight):
        if not rest:
            weights[ids] = weight
        for size in range(1, len(rest) + 1):
            if found := vocabulary.known.get(rest[:size]):
                ways(rest[size:], (*ids, found[0]), weight * found[1])

    ways("▁table", (), 1.0)
    n, total = 100_000, sum(weights.values())
    ids, ends = sampling.encoded(vocabulary, np.arange(n), pa.array(["table"] * n))
    met = collections.Counter(tuple(ids[a:b].tolist()) for a, b in zip(np.append(0, ends[:-1]), ends))
    assert set(met) <= set(weights)
    assert all(abs(met[way] / n - weight / total) < 0.006 for way, weight in weights.items())
    odd_texts = ["▁", "x" * 3000 + "😀" * 300, "\x00\n\t", "a▁b c", "日本語" * 50]
    ids, ends = sampling.encoded(vocabulary, np.arange(5), pa.array(odd_texts))
    assert [sampling.decoded(vocabulary, ids[a:b].tolist()) for a, b in zip(np.append(0, ends[:-1]), ends)] == odd_texts


# --- archives ----------------------------------------------------------------------------


def test_archives_equal_sql(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").select("page_id", "url", "html")
    more = [(10_000, None, None), (10_001, "http://a b", "x" * 999), (10_002, "u", "x" * 999), (10_003, "u", "é" * 500), (10_004, "u", "é" * 500), (10_005, "u", "a\r\n\r\nb" * 300)]
    pages = pages.unionByName(pages.withColumn("page_id", F.col("page_id") + 5000)).unionByName(spark.createDataFrame(more, pages.schema))
    arc = archives.write_arc(pages.withColumn("digest", F.lit(1)).repartition(4), work_dir(spark, "arc"))
    warc = archives.convert(spark, arc, work_dir(spark, "warc"))
    found = archives.read_warc(spark, warc)
    duck = duckdb.connect()
    duck.register("pages", pages.toArrow())
    expected = duck.execute(queries.oracle_sql()["op10_archives"]).fetchall()
    assert sorted(map(str, collected(found))) == sorted(map(str, expected))
    payloads = {r["page_id"]: r["payload"] for r in archives.read_warc(spark, warc, with_payload=True).collect()}
    html = {r["page_id"]: (r["html"] or "").encode() for r in pages.collect()}
    assert all(payload is None or bytes(payload) == html[page] for page, payload in payloads.items())
    empty = archives.write_arc(pages.limit(0), work_dir(spark, "arc"))
    assert collected(archives.read_warc(spark, archives.convert(spark, empty, work_dir(spark, "warc")))) == []


def test_arc_versions():
    class Stream:
        def __init__(self, data):
            self.data = data

        def read(self, size=None):
            part, self.data = (self.data, b"") if size is None else (self.data[:size], self.data[size:])
            return part

    for version in (1, 2):
        plain = archives.version_block("f", version) + archives.arc_record(7, "http://x y", b"<p>", version, "f")
        records = list(archives.arc_records(Stream(plain)))
        assert [r.kind for r in records] == ["warcinfo", "response"]
        assert records[1].address == "http://x%20y" and records[1].parts()[1] == b"<p>" and records[1].date == "2025-01-01T00:00:00Z"
    *whole, last = archives.arc_records(Stream(plain[:-3]))
    assert len(whole) == 1 and isinstance(last, archives.Broken) and "declares" in last.reason


# --- licenses ----------------------------------------------------------------------------


def test_licenses(spark, odd, nothing):
    texts = {
        1: "é Released under the MIT License. rest",
        2: "words Licensed under the very Apache license version 2.0 more " + "w " * 500 + "Released under the MIT License.",
        3: "Released under",
        4: " ".join(["filler"] * 50) + " " + licenses.TEMPLATES["mit-permission"].replace("merge, publish, ", "") + " end",
    }
    frame = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    found = {(r["doc_id"], r["license"]): texts[r["doc_id"]][r["start"] : r["end"]] for r in licenses.found(frame).collect()}
    assert found[1, "mit-notice"] == "Released under the MIT License."
    assert found[2, "apache-2.0-notice"] == "Licensed under the very Apache license version 2.0"
    assert found[2, "mit-notice"] == "Released under the MIT License."
    assert found[4, "mit-permission"].startswith("Permission is hereby") and found[4, "mit-permission"].endswith("to do so")
    assert len(found) == 4
    assert collected(licenses.found(nothing)) == [] and collected(licenses.found(odd)) == []
    index = licenses.Index(licenses.TEMPLATES)
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    met = collections.Counter(r["license"] for r in licenses.found(spark.read.parquet(f"{FOLDER}/documents.parquet")).collect())
    for name in ("mit-notice", "apache-2.0-notice", "gpl-3.0-notice", "cc-by-nc-4.0-notice"):
        assert met[name] == sum(r["text"].count(licenses.TEMPLATES[name]) for r in documents)
    assert len(index.names) == len(licenses.TEMPLATES)


# --- toxicity ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def judged(spark):
    rng = random.Random(6)
    words = ["the", "stone", "river", "walks", "under", "green", "light", "with", "small", "idiotic", "bridge", "loses"]
    rows = []
    for i in range(1500):
        text = [rng.choice(words[:9]) for _ in range(rng.randint(20, 60))]
        toxic = int(rng.random() < 0.3)
        if toxic:
            text[rng.randrange(len(text))] = rng.choice(["idiot", "stupid", "worthless"])
        rows.append((i, " ".join(text), toxic))
    return spark.createDataFrame(rows, "doc_id bigint, text string, toxic int").repartition(3)


def test_toxicity_learns_and_undoes_disguise(spark, judged, odd, nothing):
    model = toxicity.learned(judged.select("doc_id", "text"), judged.select("doc_id", "toxic"))
    found = {r["doc_id"]: r for r in toxicity.scored(judged, model).collect()}
    truth = {r["doc_id"]: r["toxic"] for r in judged.collect()}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert {i for i, r in found.items() if r["held_out"]} == set(held)
    assert all(found[i]["predicted"] == truth[i] == int(found[i]["score"] >= 0.5) for i in held)
    disguised = ["the 1d10t walks", "the stuuuupid stone", "under s t u p i d light", "w0rthl3ss bridge", "an id!ot, with", "s.t.u.p.i.d", None, "", "the river 555 walks"]
    frame = spark.createDataFrame(list(enumerate(disguised)), "doc_id bigint, text string")
    assert [r["predicted"] for r in sorted(toxicity.scored(frame, model).collect())] == [1, 1, 1, 1, 1, 1, 0, 0, 0]
    assert toxicity.scored(odd, model).count() == odd.count() and toxicity.clean(odd, model).columns == odd.columns
    assert collected(toxicity.scored(nothing, model)) == []
    unlabelled = toxicity.learned(nothing, judged.limit(0))
    assert {r["score"] for r in toxicity.scored(odd, unlabelled).collect()} == {0.0}


# --- queries and pipeline ----------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_queries_return_every_row(spark, name):
    result = queries.queries()[name](spark, FOLDER)
    table = {"op3_embeddings": "embeddings", "op10_archives": "pages"}.get(name, "documents")
    n = spark.read.parquet(f"{FOLDER}/{table}.parquet").count()
    rows = result.collect()
    assert len(rows) >= n if name == "op6_packing" else len(rows) == n if name not in ("op5_licenses", "op11_collocations") else len(rows) > 0


def test_pipeline_against_its_parts(spark):
    import corpus_pipeline

    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = toxicity.learned(documents, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    toxic = {r["doc_id"] for r in toxicity.scored(documents, model).collect() if r["predicted"]}
    bad = {r["doc_id"] for r in quality.verdicts(documents).collect() if not r["kept"]}
    left = {r["doc_id"]: r["text"] for r in documents.collect() if r["doc_id"] not in toxic | bad}
    prints = {i: brute_print(text) for i, text in left.items()}
    near = [(a, b) for a, b in itertools.combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 2]
    first = set(brute_components(list(prints), near).values())
    result = corpus_pipeline.run(spark, FOLDER).collect()
    assert {row["doc_id"] for row in result} == first
    scanner = secret_scan.Scanner()
    encoder = tokens.Encoder(tokens.tokenizer_path())
    ids, ends = encoder.encode(pa.array([secret_scan._masked(scanner, left[i]) for i in sorted(first)]))
    lengths = collections.Counter()
    for row in result:
        lengths[row["doc_id"]] += row["length"]
    assert [lengths[i] for i in sorted(first)] == (np.diff(ends, prepend=0) + 1).tolist()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, documents, FOLDER).columns == documents.columns, name
