"""Legacy web archives (ARC) brought into the WARC format.

An ARC file opens with a version block that names its header fields: five in
version 1, ten in version 2. Each record is one line of these fields, the last
of which declares the length, and that many bytes. The converter reads lines
and lengths as the file's version says, and writes each record as WARC with what
ARC lacks: an identifier derived from the record's place and address, an ISO date, a type
and digests. Of records with one payload of at least ``REVISIT_BYTES``, the one
with the largest page number becomes the response and the others revisits of
it.

Records are read as a stream, one at a time, whether a file is plain, one gzip member or a member for each record. Which ones are revisits is decided
by Spark over one small row per record; pages themselves are never shuffled. Files
are written under a name of their own and then moved.

Defined results: null html is an empty payload; a null address is ``about:blank``; a
record without a page number ranks behind all that have one. Extra columns are
ignored; repeated rows are records of their own. Records with a broken header, length or compression
are left out and listed by ``arc_rejects``; all others of their file are converted as far as it can be read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain, islice

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logbrook.llm.batches import stored

REVISIT_BYTES = 1000
CRAWLED = "20250101000000"
READ_BYTES = 1 << 20
LINE_BYTES = 1 << 20
ROWS = 10_000
LEVEL = 1
ARC_FILES = (".arc.gz", ".arc")

# The header fields of the two ARC versions, and the profile of a revisit.
FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: (
        "URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset",
        "Filename", "Archive-length",
    ),
}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_FIELD, LENGTH_FIELD = "X-Page-Id", "X-Payload-Length"

INDEX = "file string, number bigint, record_id string, url string, date string, page_id bigint, digest string, bytes bigint"


# --- streams of gzip members -------------------------------------------------------------


def _packed(data: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class Unpackable(ValueError):
    """Compressed bytes that end early or are none."""


class Member:
    """A gzip member, or a plain stream, read by lines and lengths. Holds what is asked for and some ``READ_BYTES``."""

    def __init__(self, chunks: Iterator[bytes]) -> None:
        self.chunks, self.held = chunks, bytearray()

    def _more(self) -> bool:
        chunk = next(self.chunks, b"")
        self.held += chunk
        return bool(chunk)

    def line(self) -> bytes | None:
        """The next line without its end, None behind the last one."""
        seen = 0
        while (end := self.held.find(b"\n", seen)) < 0:
            seen = len(self.held)
            if seen > LINE_BYTES:
                raise ValueError(f"a line of more than {LINE_BYTES} bytes where a header is due")
            if not self._more():
                return self.take(seen) or None
        return self.take(end + 1)[:-1]

    def take(self, size: int) -> bytes:
        """So many bytes, fewer only at the end."""
        while len(self.held) < size and self._more():
            pass
        data = bytes(self.held[:size])
        del self.held[:size]
        return data

    def leave(self) -> None:
        """Pass over the rest."""
        while self._more():
            self.held.clear()


def members(file) -> Iterator[Member]:
    """The gzip members of a stream, one after the other; a plain stream is one member."""
    data = file.read(READ_BYTES)
    if len(data) == 1:
        data += file.read(READ_BYTES)
    if data[:2] != b"\x1f\x8b":
        yield Member(chain([data], iter(lambda: file.read(READ_BYTES), b"")))
        return
    while data:
        rest: list[bytes] = []
        member = Member(_unpacked(file, data, rest))
        yield member
        member.leave()
        data = rest[0] or file.read(READ_BYTES)


def _unpacked(file, data: bytes, rest: list[bytes]) -> Iterator[bytes]:
    """A member's bytes, in parts; ``rest`` gets what was read beyond it."""
    unpacker = zlib.decompressobj(31)
    while not unpacker.eof:
        data = data or file.read(READ_BYTES)
        try:
            part = unpacker.decompress(data, READ_BYTES)
        except zlib.error as error:
            raise Unpackable(str(error)) from error
        if not data and not part and not unpacker.eof:
            raise Unpackable("a gzip member ends early")
        data = unpacker.unconsumed_tail
        if part:
            yield part
    rest.append(unpacker.unused_data)


def _files(folder: str, endings: tuple[str, ...]) -> list[str]:
    system, base = fs.FileSystem.from_uri(folder)
    found = system.get_file_info(fs.FileSelector(base, allow_not_found=True))
    return sorted(info.base_name for info in found if info.base_name.endswith(endings))


def _file_rows(spark: SparkSession, folder: str, *endings: str) -> DataFrame:
    names = _files(folder, endings)
    rows = spark.createDataFrame([(name,) for name in names], "file string")
    return rows.repartition(max(1, len(names)), "file") if names else rows


def _open(folder: str, name: str):
    system, base = fs.FileSystem.from_uri(folder)
    return system.open_input_stream(f"{base}/{name}", compression=None)


# --- ARC ---------------------------------------------------------------------------------


def write_arc(pages: DataFrame, folder: str, versions: tuple[int, ...] = (1, 2)) -> str:
    """Pages as ARC files, one per task, in the versions in turn."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        version = versions[number % len(versions)]
        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        name, draft = f"pages-{number:06d}.arc.gz", f"{base}/.draft-{uuid.uuid4().hex}"
        with system.open_output_stream(draft, compression=None) as out:
            out.write(_packed(version_block(name, version)))
            for batch in batches:
                for page, url, html in zip(*(column.to_pylist() for column in batch.columns)):
                    out.write(_packed(arc_record(page, url, (html or "").encode(), version, name)))
        system.move(draft, f"{base}/{name}")
        yield pa.RecordBatch.from_arrays([pa.array([name])], ["file"])

    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html")
    rows.mapInArrow(write, "file string").write.format("noop").mode("overwrite").save()
    return folder


def version_block(name: str, version: int) -> bytes:
    fields = " ".join(FIELDS[version])
    body = f"{version} 0 pages\n{fields}\n\n".encode()
    return _arc_line(f"filedesc://{name}", "text/plain", "0.0.0.0", len(body), version, name) + body + b"\n"


def arc_record(page: int | None, url: str | None, html: bytes, version: int, name: str) -> bytes:
    head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    head += "" if page is None else f"{PAGE_FIELD}: {page}\r\n"
    block = f"{head}Content-Length: {len(html)}\r\n\r\n".encode() + html
    address = re.sub(r"[\s\x00-\x1f]", lambda found: f"%{ord(found[0]):02X}", url or "about:blank")
    return _arc_line(address, "text/html", "127.0.0.1", len(block), version, name) + block + b"\n"


def _arc_line(url: str, kind: str, ip: str, length: int, version: int, name: str) -> bytes:
    more = ["200", "-", "-", "0", name] if version == 2 else []
    return " ".join([url, ip, CRAWLED, kind, *more, str(length)]).encode() + b"\n"


@dataclass
class ArcRecord:
    number: int
    fields: dict[str, str]
    block: bytes

    @property
    def address(self) -> str:
        return self.fields["URL"]

    @property
    def date(self) -> str:
        d = self.fields["Archive-date"].ljust(14, "0")
        return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"

    @property
    def kind(self) -> str:
        if self.address.startswith("filedesc:"):
            return "warcinfo"
        return "response" if self.block.startswith(b"HTTP/") else "resource"

    def parts(self) -> tuple[bytes, bytes]:
        """HTTP head and payload; without such a head all is payload."""
        head, cut, payload = self.block.partition(b"\r\n\r\n") if self.kind == "response" else (b"", b"", self.block)
        return (head + cut, payload) if cut or not head else (b"", self.block)


@dataclass
class Broken:
    """A place where a file is not as its headers say."""

    number: int
    reason: str


def arc_records(file) -> Iterator[ArcRecord | Broken]:
    """The records of an ARC stream, read as its version block says.

    Behind a broken record reading goes on with the next gzip member; in a plain
    file, and where the compression itself is broken, it ends there.
    """
    names, number = FIELDS[1], 0
    try:
        for member in members(file):
            try:
                while (line := member.line()) is not None:
                    if line.strip():
                        names, fields, block = _arc_record(line.strip(b"\r"), member, names)
                        yield ArcRecord(number, fields, block)
                        number += 1
            except (ValueError, KeyError) as error:
                yield Broken(number, str(error))
                number += 1
                if isinstance(error, Unpackable):
                    return
    except Unpackable as error:
        yield Broken(number, str(error))


def _arc_record(line: bytes, member: Member, names: tuple[str, ...]) -> tuple[tuple[str, ...], dict[str, str], bytes]:
    """A record's fields and block by its header line, and the names of the fields from here on."""
    values = line.decode("utf-8", "replace").split(" ")
    if line.startswith(b"filedesc:"):
        block = _declared(member, values[-1])
        body = block.decode("utf-8", "replace").split("\n")
        version = int(body[0].split(" ")[0])
        names = tuple(body[1].split()) if len(body) > 1 and body[1].strip() else FIELDS.get(version, ())
        if not {"URL", "IP-address", "Archive-date", "Content-type", "Archive-length"} <= set(names):
            raise ValueError(f"a version block of version {version} without the fields every record has")
        return names, dict(zip(names, [*values[:4], *[""] * (len(names) - 5), values[-1]])), block
    if len(values) < len(names):
        raise ValueError(f"a header line of {len(values)} fields, not {len(names)}")
    # Only the address may hold blanks; the other fields are counted from the end.
    fields = dict(zip(names, [" ".join(values[: 1 - len(names)]), *values[1 - len(names) :]]))
    return names, fields, _declared(member, fields["Archive-length"])


def _declared(member: Member, length: str) -> bytes:
    if not length.isdecimal():
        raise ValueError(f"a length that is no number: {length[:40]}")
    block = member.take(int(length))
    if len(block) < int(length):
        raise ValueError(f"a record that declares {int(length)} bytes and has {len(block)}")
    return block


# --- WARC --------------------------------------------------------------------------------


def record_id(file: str, record: ArcRecord) -> str:
    name = f"{file}#{record.number} {record.address} {record.date}"
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}"


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _head(name: str, head: bytes) -> str | None:
    found = re.search(rb"(?im)^" + re.escape(name.encode()) + rb":[ \t]*(.*?)\r?$", head)
    return None if found is None else found[1].decode("utf-8", "replace")


def _page_id(head: bytes) -> int | None:
    page = _head(PAGE_FIELD, head)
    number = int(page) if page and re.fullmatch(r"-?[0-9]{1,19}", page) else None
    return number if number is not None and -(1 << 63) <= number < 1 << 63 else None


def arc_index(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record of the ARC files that holds a page."""

    schema = pa.schema([("file", pa.string()), ("number", pa.int64()), ("record_id", pa.string()), ("url", pa.string()), ("date", pa.string()), ("page_id", pa.int64()), ("digest", pa.string()), ("bytes", pa.int64())])

    def rows(file: str) -> Iterator[tuple]:
        for record in arc_records(_open(folder, file)):
            if isinstance(record, ArcRecord) and record.kind != "warcinfo":
                head, payload = record.parts()
                place = (file, record.number, record_id(file, record), record.address, record.date)
                yield *place, _page_id(head), hashlib.sha1(payload).hexdigest(), len(payload)

    return _file_rows(spark, folder, *ARC_FILES).mapInArrow(_of_files(rows, schema), INDEX)


def arc_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """``file, number, reason``: the places at which ARC files are broken, which the conversion leaves out."""
    schema = pa.schema([("file", pa.string()), ("number", pa.int64()), ("reason", pa.string())])

    def rows(file: str) -> Iterator[tuple]:
        for record in arc_records(_open(folder, file)):
            if isinstance(record, Broken):
                yield file, record.number, record.reason

    return _file_rows(spark, folder, *ARC_FILES).mapInArrow(_of_files(rows, schema), "file string, number bigint, reason string")


def _of_files(rows: Callable[[str], Iterator[tuple]], schema: pa.Schema) -> Callable:
    """What a function finds in each file, in batches of bounded size."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0).to_pylist():
                found = rows(file)
                while some := list(islice(found, ROWS)):
                    yield _batch(some, schema)

    return read


def revisits(index: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """``file, number`` of every record whose payload another one holds already, and which one that is."""
    large = index.where(F.col("bytes") >= least)
    rank = F.struct("page_id", "file", "number")
    held = large.groupBy("digest").agg(
        F.max(rank).alias("kept"),
        F.max_by(F.struct("record_id", "url", "date"), rank).alias("target"),
        F.count("*").alias("times"),
    )
    held = stored(held.where("times > 1").withColumnRenamed("digest", "of").drop("times"), "payloads")
    met = large.join(held.hint("merge"), F.col("digest") == F.col("of"))
    other = met.where((F.col("file") != F.col("kept.file")) | (F.col("number") != F.col("kept.number")))
    return other.select("file", "number", "target.*", F.col("kept.page_id").alias("target_page"))


def convert(spark: SparkSession, arc: str, warc: str) -> str:
    """Write each ARC file of a folder as a WARC file into another."""
    index = stored(arc_index(spark, arc), "arc-index")
    decided = revisits(index)
    files = _file_rows(spark, arc, *ARC_FILES)

    def write(key: tuple, mine: pa.Table, others: pa.Table) -> pa.Table:
        for file in mine.column("file").to_pylist():
            seen = {row["number"]: row for row in others.to_pylist()}
            system, base = fs.FileSystem.from_uri(warc)
            system.create_dir(base, recursive=True)
            draft = f"{base}/.draft-{uuid.uuid4().hex}"
            with system.open_output_stream(draft, compression=None) as out:
                for record in arc_records(_open(arc, file)):
                    if isinstance(record, ArcRecord):
                        out.write(_packed(warc_record(file, record, seen.get(record.number))))
            system.move(draft, f"{base}/{warc_name(file)}")
        return pa.table({"file": pa.array([], pa.string())})

    done = files.groupBy("file").cogroup(decided.groupBy("file")).applyInArrow(write, "file string")
    done.write.format("noop").mode("overwrite").save()
    return warc


def warc_name(file: str) -> str:
    """Where an ARC file's records go; ``a.arc`` and ``a.arc.gz`` may lie side by side."""
    return f"{file.removesuffix('.arc.gz')}.warc.gz" if file.endswith(".gz") else f"{file}.warc.gz"


def warc_record(file: str, record: ArcRecord, revisit: dict | None) -> bytes:
    """A record in WARC; as a revisit, with its HTTP head alone."""
    head, payload = record.parts()
    kind = "revisit" if revisit else record.kind
    block = head if revisit else record.block
    fields = {"WARC-Type": kind, "WARC-Record-ID": f"<{record_id(file, record)}>", "WARC-Date": record.date}
    if kind == "warcinfo":
        fields["WARC-Filename"] = file.replace(".arc", ".warc")
        block = b"format: WARC File Format 1.1\r\nconverted-from: " + record.address.encode() + b"\r\n"
        fields["Content-Type"] = "application/warc-fields"
    else:
        fields["WARC-Target-URI"] = record.address
        fields["WARC-IP-Address"] = record.fields["IP-address"]
        fields["WARC-Payload-Digest"] = _sha1(payload)
        fields[LENGTH_FIELD] = str(len(payload))
        http = record.kind == "response"
        fields["Content-Type"] = "application/http; msgtype=response" if http else record.fields["Content-type"]
    if revisit:
        fields["WARC-Profile"] = PROFILE
        fields["WARC-Refers-To"] = f"<{revisit['record_id']}>"
        fields["WARC-Refers-To-Target-URI"] = revisit["url"]
        fields["WARC-Refers-To-Date"] = revisit["date"]
        if revisit["target_page"] is not None:
            fields["X-Refers-To-Page-Id"] = str(revisit["target_page"])
    fields["WARC-Block-Digest"] = _sha1(block)
    fields["Content-Length"] = str(len(block))
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields.items())
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def warc_records(file) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of a WARC stream, digests checked."""
    for member in members(file):
        while (line := member.line()) is not None:
            if not line.strip():
                continue
            fields = {}
            while (line := member.line()) and line != b"\r":
                name, _, value = line.decode().removesuffix("\r").partition(": ")
                fields[name] = value
            block = member.take(int(fields["Content-Length"]))
            if _sha1(block) != fields["WARC-Block-Digest"]:
                raise ValueError(f"digest of {fields['WARC-Record-ID']}")
            yield fields, block


def read_warc(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """Pages out of WARC files: ``page_id, payload_bytes, payload_digest, record_type, refers_to`` and, if asked for,
    ``url`` and ``payload`` (null for revisits)."""
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
    if with_payload:
        schema = schema.append(pa.field("url", pa.string())).append(pa.field("payload", pa.binary()))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0).to_pylist():
                rows, held = [], 0
                for fields, block in warc_records(_open(folder, file)):
                    if fields["WARC-Type"] != "warcinfo":
                        rows.append(_page(fields, block)[: len(schema)])
                        held += len(block)
                    if held > READ_BYTES * 16:
                        yield _batch(rows, schema)
                        rows, held = [], 0
                yield _batch(rows, schema)

    ddl = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    return _file_rows(spark, folder, ".warc.gz").mapInArrow(read, ddl + ", url string, payload binary" * with_payload)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _page(fields: dict[str, str], block: bytes) -> tuple:
    head, cut, payload = block.partition(b"\r\n\r\n") if block.startswith(b"HTTP/") else (b"", b"", block)
    stated = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    kind = fields["WARC-Type"]
    if kind == "revisit":
        size, payload = int(fields[LENGTH_FIELD]), None
    else:
        size = len(payload)
        if hashlib.sha1(payload).hexdigest() != stated:
            raise ValueError(f"payload digest of {fields['WARC-Record-ID']}")
    target = fields.get("X-Refers-To-Page-Id")
    return _page_id(head), size, stated, kind, None if target is None else int(target), fields["WARC-Target-URI"], payload
