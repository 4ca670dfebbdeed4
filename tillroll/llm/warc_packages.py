"""Records of web-archive packages that any tool wrote (``warc`` reads those of its own writer).

A package is a ZIP file whose members are stored: ``archive/*.warc.gz`` (a gzip member per
record) or ``archive/*.warc``, and indexes ``indexes/*.cdx``, ``*.cdxj`` or ``*.cdx.gz``.  Nothing
is extracted: records are found by the index lines that name their member, or, for members
that no index names (or with ``use_index=False``), by a scan in ranges of ``CHUNK`` bytes, and
are then read by ranges.  An index lists what its writer chose to, often responses only.

Header names are compared without case, folded lines are joined, digests may be SHA-1,
SHA-256, SHA-512 or MD5 in base32 or hexadecimal.  ``payload`` is the block without its HTTP head,
as archived (transfer encodings stay); null for revisits.  ``digest_ok`` is null where there
is no payload, no digest or an unknown algorithm.  A compressed (not stored) member, a record
that ends early and a missing length fail the job.  A null path and a package without archive
members give no record; a path given twice is read twice.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import zlib
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import map_arrow
from tillroll.llm.warc import BLOCK_RECORDS, ZipRanges, _File, _uri

CHUNK = 1 << 20  # bytes of a member that a scan holds
BLOCK_BYTES = 16 << 20  # records fetched with one range, unless a single one is longer
BREAK = b"\r\n\r\n"


def headers(block: bytes) -> tuple[str, dict[str, str]]:
    """Version or status line, and fields by lower-case name (the first of equal names)."""
    first, *lines = block.decode("utf-8", "replace").split("\r\n")
    folded: list[str] = []
    for line in lines:
        if line[:1] in (" ", "\t") and folded:
            folded[-1] += " " + line.strip()
        else:
            folded.append(line)
    fields: dict[str, str] = {}
    for line in folded:
        name, colon, value = line.partition(":")
        if colon:
            fields.setdefault(name.strip().lower(), value.strip())
    return first, fields


def digest_matches(labelled: str | None, payload: bytes) -> bool | None:
    kind, _, value = (labelled or "").partition(":")
    kind, value = kind.strip().lower().replace("-", ""), value.strip()
    if kind not in ("md5", "sha1", "sha256", "sha512"):
        return None
    raw = hashlib.new(kind, payload).digest()
    base32 = base64.b32encode(raw).decode().rstrip("=")
    return value.lower() == raw.hex() or value.upper().rstrip("=") == base32


def decode_standard(data: bytes) -> dict:
    """The fields of the record at the start of ``data``, plain or a gzip member."""
    if data[:2] == b"\x1f\x8b":
        engine = zlib.decompressobj(31)
        data = engine.decompress(data)
        if not engine.eof:
            raise ValueError("a gzip member ends early")
    end = data.find(BREAK)
    version, head = headers(data[: max(end, 0)])
    if not version.startswith("WARC/") or "content-length" not in head:
        raise ValueError("WARC version line and Content-Length expected")
    size = int(head["content-length"])
    block = data[end + 4 : end + 4 + size]
    if len(block) != size:
        raise ValueError("a record ends before its Content-Length")
    kind = head.get("warc-type", "").lower()
    payload = None if kind == "revisit" else block
    if payload is not None and head.get("content-type", "").lower().startswith("application/http"):
        _, gap, payload = block.partition(BREAK)
    digest = head.get("warc-payload-digest")
    target = head.get("warc-target-uri")
    return {
        "record_uri": head.get("warc-record-id"), "record_type": kind or None,
        "url": target.strip("<>") if target is not None else None,
        "date": head.get("warc-date"), "content_type": head.get("content-type"),
        "payload_digest": digest,
        "digest_ok": None if payload is None else digest_matches(digest, payload),
        "refers_to_uri": head.get("warc-refers-to"),
        "refers_to_url": head.get("warc-refers-to-target-uri"),
        "payload": payload,
    }


def index_entries(text: str) -> Iterator[tuple[str, int, int]]:
    """(file name, offset, length) of index lines: ``key time {json}``, or the JSON alone.
    Lines without the three fields (headers) are passed over."""
    for line in text.splitlines():
        brace = line.find("{")
        if brace < 0 or line.startswith("!"):
            continue
        entry = json.loads(line[brace:])
        if all(entry.get(k) is not None for k in ("filename", "offset", "length")):
            yield entry["filename"].rsplit("/", 1)[-1], int(entry["offset"]), int(entry["length"])


def gzip_members(read_at, start: int, size: int, chunk: int = CHUNK) -> Iterator[tuple[int, int]]:
    """(offset, length) of each gzip member in a range; holds ``chunk`` bytes in and out."""
    at = begin = 0
    engine = zlib.decompressobj(31)
    while at < size:
        data = read_at(start + at, min(chunk, size - at))
        at += len(data)
        while True:
            out = engine.decompress(data, chunk)
            if engine.eof:
                data, engine = engine.unused_data, zlib.decompressobj(31)
                yield begin, at - len(data) - begin
                begin = at - len(data)
                if not data:
                    break
            else:
                data = engine.unconsumed_tail
                if not data and len(out) < chunk:
                    break
    if begin != size:
        raise ValueError("a gzip member ends early")


def plain_records(read_at, start: int, size: int, chunk: int = 4096) -> Iterator[tuple[int, int]]:
    """(offset, length) of each uncompressed record in a range; blocks are skipped, not read."""
    at = 0
    while at < size:
        head = b""
        while (end := head.find(BREAK)) < 0:
            more = read_at(start + at + len(head), min(chunk, size - at - len(head)))
            if not more:
                raise ValueError("a record head ends early")
            head += more
        length = end + 4 + int(headers(head[:end])[1]["content-length"])
        if at + length > size:
            raise ValueError("a record ends before its Content-Length")
        length = min(length + 4, size - at)
        yield at, length
        at += length


def _is_archive(name: str) -> bool:
    return name.startswith("archive/") and name.endswith((".warc", ".warc.gz"))


def _is_index(name: str) -> bool:
    return name.startswith("indexes/") and name.endswith((".cdx", ".cdxj", ".cdx.gz", ".cdxj.gz"))


def _runs(found: list[tuple[int, int]] | Iterator[tuple[int, int]]) -> Iterator[tuple[int, list[int]]]:
    """Adjacent records as blocks of one range: (offset of the first, lengths)."""
    first, lengths, total = 0, [], 0
    for offset, length in found:
        adjacent = offset == first + total
        if lengths and (not adjacent or len(lengths) == BLOCK_RECORDS or total + length > BLOCK_BYTES):
            yield first, lengths
            lengths, total = [], 0
        if not lengths:
            first = offset
        lengths.append(length)
        total += length
    if lengths:
        yield first, lengths


def locate(archives: DataFrame, path_col: str = "path", use_index: bool = True) -> DataFrame:
    """Blocks of records of each package: (archive, member, start, first, lengths)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with _File(_uri(path)) as f:
                    package = ZipRanges(f.read_at, f.size)
                    listed = defaultdict(set)
                    for name, member in package.members.items():
                        if use_index and _is_index(name):
                            raw = package.read(member)
                            raw = gzip.decompress(raw) if name.endswith(".gz") else raw
                            for file, offset, length in index_entries(raw.decode()):
                                listed[file].add((offset, length))
                    for name, member in package.members.items():
                        if not _is_archive(name):
                            continue
                        start, own = package.start(member), listed.get(name.rsplit("/", 1)[-1])
                        scan = gzip_members if name.endswith(".gz") else plain_records
                        found = sorted(own) if own else scan(f.read_at, start, member.size)
                        for first, lengths in _runs(found):
                            yield pa.RecordBatch.from_pydict({
                                "archive": [path], "member": [name],
                                "start": pa.array([start], pa.int64()),
                                "first": pa.array([first], pa.int64()),
                                "lengths": pa.array([lengths], pa.list_(pa.int64())),
                            })

    paths = archives.select(F.col(path_col).cast("string").alias("path")).where("path IS NOT NULL")
    return map_arrow(paths, read, "archive string, member string, start long, first long, lengths array<bigint>")


_FIELDS = pa.schema([
    ("archive", pa.string()), ("member", pa.string()), ("offset", pa.int64()),
    ("record_uri", pa.string()), ("record_type", pa.string()), ("url", pa.string()),
    ("date", pa.string()), ("content_type", pa.string()), ("payload_digest", pa.string()),
    ("digest_ok", pa.bool_()), ("refers_to_uri", pa.string()), ("refers_to_url", pa.string()),
    ("payload", pa.binary()),
])


def read_located(blocks: DataFrame) -> DataFrame:
    """The records of ``locate`` blocks, each block fetched with one range read.  Spread the
    blocks first (``repartition``) where few packages hold many records."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, member, start, first, lengths in zip(*(c.to_pylist() for c in batch.columns)):
                with _File(_uri(archive)) as f:
                    data = f.read_at(start + first, sum(lengths))
                rows, at = [], 0
                for n in lengths:
                    place = {"archive": archive, "member": member, "offset": first + at}
                    rows.append(place | decode_standard(data[at : at + n]))
                    at += n
                yield pa.RecordBatch.from_pylist(rows, _FIELDS)

    ddl = (
        "archive string, member string, offset long, record_uri string, record_type string, "
        "url string, date string, content_type string, payload_digest string, digest_ok boolean, "
        "refers_to_uri string, refers_to_url string, payload binary"
    )
    return map_arrow(blocks.select("archive", "member", "start", "first", "lengths"), read, ddl)
