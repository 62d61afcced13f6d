"""Archives that are plain, whole-file gzip or broken; token files cut by size."""

import gzip
import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from logbrook.llm import archives, token_files
from logbrook.session import work_dir

PAGES = [(page, f"http://p/{page}", f"<p>{page}</p>" * 40 * page) for page in range(1, 8)]


def arc_bytes(version, pages=PAGES):
    return [archives.version_block("f", version)] + [archives.arc_record(n, u, t.encode(), version, "f") for n, u, t in pages]


def folder_of(spark, files):
    folder = work_dir(spark, "arc-in")
    os.makedirs(folder)
    for name, data in files.items():
        with open(f"{folder}/{name}", "wb") as out:
            out.write(data)
    return folder


class Stream:
    """Gives a few bytes at a time, and counts how far it was read."""

    def __init__(self, data, step):
        self.data, self.step, self.at = data, step, 0

    def read(self, size=None):
        part = self.data[self.at : self.at + min(size, self.step)]
        self.at += len(part)
        return part


@pytest.mark.parametrize("step", [1, 7, 1 << 20])
@pytest.mark.parametrize("version", [1, 2])
def test_any_form_of_a_file_gives_the_same_records(version, step):
    parts = arc_bytes(version)
    forms = [b"".join(parts), gzip.compress(b"".join(parts)), b"".join(map(gzip.compress, parts))]
    for form in forms:
        records = list(archives.arc_records(Stream(form, step)))
        assert [r.number for r in records] == list(range(8))
        assert [r.parts()[1].decode() for r in records[1:]] == [html for _, _, html in PAGES]


def test_a_plain_file_is_read_as_it_is_needed(monkeypatch):
    monkeypatch.setattr(archives, "READ_BYTES", 64)
    pages = [(n, "http://p", "x" * 500) for n in range(200)]
    stream = Stream(b"".join(arc_bytes(1, pages)), 64)
    records = archives.arc_records(stream)
    for _ in range(10):
        next(records)
    assert stream.at < len(stream.data) / 10


def test_a_member_may_unpack_to_far_more_than_is_held(monkeypatch):
    monkeypatch.setattr(archives, "READ_BYTES", 1000)
    pages = [(n, "http://p", "x" * 3000) for n in range(300)]
    member = next(archives.members(Stream(gzip.compress(b"".join(arc_bytes(1, pages))), 1000)))
    assert member.line().startswith(b"filedesc:") and len(member.held) <= 2000


def test_broken_files_convert_as_far_as_they_go(spark):
    first, *pages = arc_bytes(1)
    short = pages[2].replace(b"text/html", b"text/html " + b"9", 1)  # one field too many: read as part of the address
    wrong = pages[3][: pages[3].index(b"\n")].rsplit(b" ", 1)[0] + b" many\n" + pages[3][pages[3].index(b"\n") + 1 :]
    packed = [gzip.compress(part) for part in (first, *pages)]
    files = {
        "good.arc": first + b"".join(pages),
        "good.arc.gz": b"".join(packed),
        "cut.arc": (first + pages[0] + pages[1])[:-5],
        "cut.arc.gz": b"".join(packed[:3])[:-60],
        "tail.arc.gz": b"".join(packed[:2])[:-4],  # the record is whole, the checksum behind it is not
        "header.arc.gz": b"".join([*packed[:4], gzip.compress(wrong), *packed[5:]]),
        "long.arc.gz": b"".join([packed[0], gzip.compress(pages[0][:-20]), packed[2]]),
        "noise.arc.gz": packed[0] + packed[1] + b"\x1f\x8bnoise",
        "plain.arc": first + wrong + pages[4],
        "version.arc": b"filedesc://f 0.0.0.0 20250101000000 text/plain 10\n9 0 pages\n\n",
        "empty.arc": b"",
        "zero.arc.gz": b"",
        "odd.arc": first + short,
    }
    folder = folder_of(spark, files)
    warc = archives.convert(spark, folder, work_dir(spark, "warc"))
    found = archives.read_warc(spark, warc).groupBy("page_id").count().collect()
    # Pages by how many of the files hold them whole.
    assert {r["page_id"]: r["count"] for r in found} == {1: 7, 2: 4, 3: 4, 4: 2, 5: 3, 6: 3, 7: 3}
    rejects = {(r["file"], r["number"]) for r in archives.arc_rejects(spark, folder).collect()}
    assert rejects == {
        ("cut.arc", 2), ("cut.arc.gz", 2), ("header.arc.gz", 4), ("long.arc.gz", 1), ("noise.arc.gz", 2), ("plain.arc", 1),
        ("tail.arc.gz", 2), ("version.arc", 0),
    }
    assert len([name for name in os.listdir(warc) if name.endswith(".warc.gz")]) == len(files)


@pytest.mark.parametrize("size", [1, 40, 400, 1 << 20])
def test_token_files_by_size(spark, size, monkeypatch):
    texts = [(n // 2 - 3, "word " * (n * 7 % 23)) for n in range(120)] + [(None, "none"), (9, None), (9, "long " * 900)]
    documents = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3)
    folder = token_files.write(documents, work_dir(spark, "token-files"), shard_bytes=size)
    shards = spark.read.parquet(f"{folder}/manifest").collect()
    assert sum(s["documents"] for s in shards) == len(texts)
    sizes = [s["ids"] * 2 for s in shards]
    assert size == 1 << 20 or len(shards) > (100 if size == 1 else 5)
    longest = max(r["n_tokens"] for r in token_files.read(spark, folder).collect()) * 2
    assert max(sizes) < size + longest + 2

    monkeypatch.setattr(token_files, "READ_IDS", 16)
    rows = sorted(token_files.read(spark, folder, with_ids=True).collect(), key=lambda r: r["start"])
    whole = token_files.write(documents, work_dir(spark, "token-files"))
    expected = sorted(token_files.read(spark, whole, with_ids=True).collect(), key=lambda r: r["start"])
    assert rows == expected
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in rows)
    assert [r["doc_id"] for r in rows] == sorted((k for k, _ in texts), key=lambda k: (k is not None, k))


def test_lookup_without_a_product(spark):
    texts = [(n // 3 * 2, f"text {n}") for n in range(60)]
    documents = spark.createDataFrame(texts, "doc_id bigint, text string")
    folder = token_files.write(documents, work_dir(spark, "token-files"), shard_bytes=8)
    keys = spark.createDataFrame([(n,) for n in range(-3, 50)] + [(4,), (None,)], "doc_id bigint")
    found = token_files.lookup(spark, folder, keys)
    plan = found._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    counts = {r["doc_id"]: r["n"] for r in found.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert counts == {2 * n: 3 for n in range(20)}
    empty = token_files.write(documents.limit(0), work_dir(spark, "token-files"), shard_bytes=8)
    assert token_files.lookup(spark, empty, keys).count() == 0 and token_files.read(spark, empty).count() == 0
