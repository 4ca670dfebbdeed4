"""WARC records in ZIP-packaged archives: writer, and reader by byte ranges.

An archive is a ZIP file (layout of a packaged web archive) with two *stored* members:
``archive/data.warc.gz`` (one gzip member per WARC/1.1 record) and ``indexes/index.cdxj``
(one line per record: offset and length within the first member).  The reader never
extracts a member: it reads the end-of-central-directory record, the ZIP64 locator and
record where present, the central directory, the index, and then byte ranges of records.

Each task writes its own archives under a name no other attempt uses and reports them in
the manifest; a retried task reports its own files only, and files of lost attempts are
never read.  Files are opened with ``pyarrow.fs`` so the folder may be on any store it
reaches (shared mount, HDFS, S3).

Cases: a null payload is an empty one; a null url has no target header; rows with equal
ids are separate records; an empty table gives no archive.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import clash_proof, map_arrow

DATA_MEMBER = "archive/data.warc.gz"
INDEX_MEMBER = "indexes/index.cdxj"
ARCHIVE_BYTES = 16 << 20  # an archive is closed when its records reach this size
BLOCK_RECORDS = 256  # records that the reader fetches with one range
MIN_REVISIT_BYTES = 100

_LOCAL, _CENTRAL, _END, _END64, _LOC64 = (
    b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07",
)
_MAX16, _MAX32 = 0xFFFF, 0xFFFFFFFF


# ------------------------------------------------------------------------------ ZIP


def build_zip(members: list[tuple[str, bytes]], zip64: bool | None = None) -> bytes:
    """A ZIP file with stored members.  ``zip64``: use ZIP64 fields (default: if needed)."""
    if zip64 is None:
        zip64 = sum(len(d) + 200 for _, d in members) >= _MAX32 or len(members) >= _MAX16
    out, central = bytearray(), bytearray()
    for name, data in members:
        raw, crc, at = name.encode(), zlib.crc32(data), len(out)
        version, size = (45, _MAX32) if zip64 else (20, len(data))
        extra = struct.pack("<HHQQ", 1, 16, len(data), len(data)) if zip64 else b""
        fields = (version, 0x800, 0, 0, 0x21, crc, size, size, len(raw))
        out += _LOCAL + struct.pack("<HHHHHIIIHH", *fields, len(extra)) + raw + extra + data
        if zip64:
            extra = struct.pack("<HHQQQ", 1, 24, len(data), len(data), at)
        central += _CENTRAL + struct.pack("<H", version)
        central += struct.pack("<HHHHHIIIHH", *fields, len(extra))
        central += struct.pack("<HHHII", 0, 0, 0, 0, _MAX32 if zip64 else at) + raw + extra
    start, count = len(out), len(members)
    out += central
    if zip64:
        end = len(out)
        out += _END64 + struct.pack(
            "<QHHIIQQQQ", 44, 45, 45, 0, 0, count, count, len(central), start
        )
        out += _LOC64 + struct.pack("<IQI", 0, end, 1)
    n, size, at = (_MAX16, _MAX32, _MAX32) if zip64 else (count, len(central), start)
    out += _END + struct.pack("<HHHHIIH", 0, 0, n, n, size, at, 0)
    return bytes(out)


@dataclass(frozen=True)
class Member:
    name: str
    method: int  # 0: stored
    crc: int
    packed: int
    size: int
    header: int  # offset of the local header


class ZipRanges:
    """Directory and byte ranges of a ZIP file behind ``read_at(offset, length)``."""

    def __init__(self, read_at: Callable[[int, int], bytes], size: int):
        self.read_at, self.size = read_at, size
        self.members = {m.name: m for m in self._directory()}

    def _directory(self) -> Iterator[Member]:
        tail_at = max(0, self.size - 22 - _MAX16)
        tail = self.read_at(tail_at, self.size - tail_at)
        end = tail.rfind(_END)
        while end >= 0:  # the signature may also stand in a comment
            if end + 22 <= len(tail):
                (comment,) = struct.unpack_from("<H", tail, end + 20)
                if end + 22 + comment == len(tail):
                    break
            end = tail.rfind(_END, 0, end)
        if end < 0:
            raise ValueError("no end of central directory: not a ZIP file")
        _, _, _, count, length, start = struct.unpack_from("<HHHHII", tail, end + 4)
        locator_at = tail_at + end - 20
        locator = self.read_at(locator_at, 20) if locator_at >= 0 else b""
        if locator[:4] == _LOC64:
            (end64,) = struct.unpack_from("<Q", locator, 8)
            record = self.read_at(end64, 56)
            if record[:4] != _END64:
                raise ValueError("ZIP64 locator points to no ZIP64 record")
            count, length, start = struct.unpack_from("<QQQ", record, 32)
        elif _MAX32 in (length, start) or count == _MAX16:
            raise ValueError("ZIP64 sizes without a ZIP64 record")
        directory, at = self.read_at(start, length), 0
        for _ in range(count):
            if directory[at : at + 4] != _CENTRAL:
                raise ValueError("central directory entry expected")
            method, _, _, crc, packed, size, n, e, c = struct.unpack_from(
                "<HHHIIIHHH", directory, at + 10
            )
            (header,) = struct.unpack_from("<I", directory, at + 42)
            name = directory[at + 46 : at + 46 + n].decode()
            extra, at = directory[at + 46 + n : at + 46 + n + e], at + 46 + n + e + c
            while len(extra) >= 4:
                tag, width = struct.unpack_from("<HH", extra)
                if tag == 1:  # only fields that did not fit are present, in this order
                    values = list(struct.unpack_from(f"<{width // 8}Q", extra, 4))
                    size = values.pop(0) if size == _MAX32 else size
                    packed = values.pop(0) if packed == _MAX32 else packed
                    header = values.pop(0) if header == _MAX32 else header
                extra = extra[4 + width :]
            yield Member(name, method, crc, packed, size, header)

    def start(self, member: Member) -> int:
        """Offset of a stored member's first byte."""
        if member.method:
            raise ValueError(f"{member.name} is not stored; ranges need stored members")
        head = self.read_at(member.header, 30)
        if head[:4] != _LOCAL:
            raise ValueError(f"no local header for {member.name}")
        name, extra = struct.unpack_from("<HH", head, 26)
        return member.header + 30 + name + extra

    def read(self, member: Member) -> bytes:
        return self.read_at(self.start(member), member.size)


class _File:
    """``read_at`` over a path of any file system that pyarrow knows."""

    def __init__(self, uri: str):
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(uri)
        self.file = system.open_input_file(path)
        self.size = self.file.size()

    def read_at(self, offset: int, length: int) -> bytes:
        return self.file.read_at(length, offset)

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.file.close()


def _uri(path: str) -> str:
    return path if ":/" in path else f"file://{path}"


# ----------------------------------------------------------------------------- WARC


def encode_record(
    record_id: int | None, url: str | None, payload: bytes, digest: str,
    refers_to: int | None, date: str,
) -> bytes:
    """One WARC/1.1 record as a gzip member: a response, or a revisit of ``refers_to``."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    http += b"Content-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if refers_to is None else http
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>",
        f"WARC-Date: {date}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Bytes: {len(payload)}",
    ]
    if record_id is not None:
        head.append(f"X-Row-ID: {record_id}")
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=_URL_SAFE)}")
    if refers_to is not None:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"X-Refers-To-Row: {refers_to}")
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return gzip.compress(raw, 1, mtime=0)


# everything printable but the percent sign, so that unquote() gives the url back
_URL_SAFE = "".join(chr(c) for c in range(33, 127) if chr(c) != "%")


def decode_record(data: bytes) -> dict:
    """The fields of one record, its payload digest checked (responses)."""
    raw = gzip.decompress(data)
    at = raw.index(b"\r\n\r\n")
    lines = raw[:at].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("WARC version line expected")
    head = dict(line.split(": ", 1) for line in lines[1:])
    block = raw[at + 4 : at + 4 + int(head["Content-Length"])]
    digest, kind = head["WARC-Payload-Digest"].removeprefix("sha256:"), head["WARC-Type"]
    payload = None
    if kind == "response":
        payload = block[block.index(b"\r\n\r\n") + 4 :]
        if len(payload) != int(head["X-Payload-Bytes"]):
            raise ValueError("payload length differs from its header")
        if hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError("payload digest differs from its header")
    number = lambda name: int(head[name]) if name in head else None
    return {
        "record_id": number("X-Row-ID"),
        "url": unquote(head["WARC-Target-URI"]) if "WARC-Target-URI" in head else None,
        "record_type": kind,
        "payload_bytes": number("X-Payload-Bytes"),
        "payload_digest": digest,
        "refers_to": number("X-Refers-To-Row"),
        "payload": payload,
    }


# ------------------------------------------------------------------------ operators


@clash_proof("id_col", "payload_col")
def mark_revisits(
    df: DataFrame, id_col: str, payload_col: str, min_bytes: int = MIN_REVISIT_BYTES
) -> DataFrame:
    """``df`` plus ``_digest`` (SHA-256 hex) and ``_refers_to``: the smallest id of the
    rows with an equal payload of at least ``min_bytes`` bytes, null for that row itself.

    Payloads are shuffled once, by row id.  Finding copies moves digests only, and first
    counts them per digest, so a payload that a third of the rows share meets in a task as
    one partial row per input split.
    """
    raw = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = df.withColumn("_digest", F.sha2(raw, 256))
    narrow = rows.where(F.length(raw) >= min_bytes).select(
        F.col(id_col).alias("_id"), F.col("_digest").alias("_d")
    )
    first = (
        narrow.groupBy(F.col("_d").alias("_fd"))
        .agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
        .where("_n > 1 AND _first IS NOT NULL")
    )
    revisits = (
        narrow.join(first, F.col("_d") == F.col("_fd"))
        .where(~F.col("_id").eqNullSafe(F.col("_first")))
        .select("_id", "_d", F.col("_first").alias("_refers_to"))
        .distinct()
    )
    same = F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("_digest") == F.col("_d"))
    return rows.join(revisits, same, "left").drop("_id", "_d")


def write_archives(
    df: DataFrame, folder: str, id_col: str, url_col: str, payload_col: str,
    date: str = "1970-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES,
    zip64: bool | None = None,
) -> DataFrame:
    """Write the rows of ``mark_revisits`` as archives below ``folder``.

    Returns the manifest (archive, n_records, n_bytes), lazily: store it before reading,
    so that each archive is written once.
    """
    rows = df.select(
        F.col(id_col).cast("long").alias("record_id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col), F.lit("")).cast("binary").alias("payload"),
        "_digest", F.col("_refers_to").cast("long"),
    )
    folder = _uri(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        body, index = bytearray(), []

        def close() -> pa.RecordBatch:
            name = f"{uuid.uuid4().hex}.wacz"
            lines = "".join(f"{json.dumps(x, separators=(',', ':'))}\n" for x in index)
            data = build_zip([(DATA_MEMBER, bytes(body)), (INDEX_MEMBER, lines.encode())], zip64)
            with system.open_output_stream(f"{base}/{name}") as out:
                out.write(data)
            row = pa.RecordBatch.from_pydict(
                {"archive": [f"{folder}/{name}"], "n_records": [len(index)], "n_bytes": [len(data)]},
            )
            body.clear()
            index.clear()
            return row

        for batch in batches:
            for i in range(batch.num_rows):
                record_id, url, payload, digest, refers = (c[i].as_py() for c in batch.columns)
                record = encode_record(record_id, url, payload, digest, refers, date)
                index.append({"id": record_id, "offset": len(body), "length": len(record)})
                body.extend(record)
                if len(body) >= archive_bytes:
                    yield close()
        if index:
            yield close()

    return map_arrow(rows, write, "archive string, n_records long, n_bytes long")


def read_index(manifest: DataFrame, block: int = BLOCK_RECORDS) -> DataFrame:
    """Blocks of records, from each archive's directory and index member."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column("archive").to_pylist():
                with _File(archive) as f:
                    package = ZipRanges(f.read_at, f.size)
                    start = package.start(package.members[DATA_MEMBER])
                    index = package.read(package.members[INDEX_MEMBER])
                entries = [json.loads(line) for line in index.splitlines()]
                for k in range(0, len(entries), block):
                    part = entries[k : k + block]
                    yield pa.RecordBatch.from_pydict({
                        "archive": [archive],
                        "first": pa.array([start + part[0]["offset"]], pa.int64()),
                        "lengths": pa.array([[e["length"] for e in part]], pa.list_(pa.int64())),
                    })

    schema = "archive string, first long, lengths array<bigint>"
    return map_arrow(manifest.select("archive"), read, schema)


_RECORD = pa.schema([
    ("record_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("refers_to", pa.int64()), ("payload", pa.binary()),
])


def read_records(blocks: DataFrame, payload: bool = True) -> DataFrame:
    """The records of ``read_index`` blocks, each block fetched with one range read.
    ``payload``: return payloads (null for revisits) too; digests are checked anyway."""
    schema = _RECORD if payload else pa.schema(list(_RECORD)[:-1])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, first, lengths in zip(*(c.to_pylist() for c in batch.columns)):
                with _File(archive) as f:
                    data = f.read_at(first, sum(lengths))
                rows, at = [], 0
                for n in lengths:
                    rows.append(decode_record(data[at : at + n]))
                    at += n
                yield pa.RecordBatch.from_pylist(rows, schema)

    ddl = "record_id long, url string, record_type string, payload_bytes long, " \
        "payload_digest string, refers_to long" + ", payload binary" * payload
    return map_arrow(blocks, read, ddl)
