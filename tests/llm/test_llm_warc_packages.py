"""Packages as other tools write them: zipfile's ZIP, standard headers, real index lines."""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import zipfile

import pytest

from tillroll.llm import warc, warc_packages as wp

HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"


def record(kind, block, *lines):
    head = ["WARC/1.0", f"warc-type:{kind}", *lines, f"CONTENT-LENGTH:  {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def sha1(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


BODY = "é\r\n\r\nbody ".encode() * 400
RECORDS = [
    record("warcinfo", b"software: x\r\n", "WARC-Record-ID: <urn:uuid:0>", "Content-Type: application/warc-fields"),
    record("response", HTTP + BODY, "WARC-Record-ID: <urn:uuid:1>", "WARC-Target-URI: <http://x/a b>",
           "Content-Type: application/http;", " msgtype=response", f"WARC-Payload-Digest: {sha1(BODY)}"),
    record("response", HTTP, "WARC-Target-URI: http://x/empty", "Content-Type: application/http",
           "WARC-Payload-Digest: sha256:" + "0" * 64),
    record("revisit", HTTP, "WARC-Target-URI: http://x/b", "WARC-Refers-To: <urn:uuid:1>",
           "WARC-Refers-To-Target-URI: http://x/a", f"WARC-Payload-Digest: {sha1(BODY)}"),
    record("resource", b"\r\n\r\nplain", "Content-Type: text/plain", "WARC-Payload-Digest: crc:1"),
]
TYPES = ["warcinfo", "response", "response", "revisit", "resource"]


def package(path, index, plain=False):
    parts = RECORDS if plain else [gzip.compress(r) for r in RECORDS]
    name, at, lines = f"data.warc{'' if plain else '.gz'}", 0, ["!meta {}", 'com,x)/ 2020 {"url": "no place"}']
    for k, part in enumerate(parts):
        if k in index:
            place = {"filename": name, "offset": str(at), "length": str(len(part)), "url": "http://x"}
            lines.append(f"com,x)/ 20200101000000 {json.dumps(place)}")
        at += len(part)
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("datapackage.json", "{}", compress_type=zipfile.ZIP_DEFLATED)
        z.writestr(f"archive/{name}", b"".join(parts))
        if index:
            z.writestr("indexes/index.cdx.gz", gzip.compress("\n".join(lines).encode()))
    return str(path)


def test_records_of_other_writers(spark, tmp_path):
    paths = [
        (package(tmp_path / "scan.wacz", ()), 1), (package(tmp_path / "plain.wacz", (), plain=True), 2),
        (package(tmp_path / "index.wacz", (1, 3, 4)), 3), (None, 4),
    ]
    df = spark.createDataFrame(paths, "path string, member long")
    got = {}
    for r in wp.read_located(wp.locate(df).repartition(3)).collect():
        got.setdefault(r.archive.rsplit("/", 1)[1], []).append(r)
    kinds = {k: [r.record_type for r in sorted(v, key=lambda r: r.offset)] for k, v in got.items()}
    assert kinds == {"scan.wacz": TYPES, "plain.wacz": TYPES, "index.wacz": ["response", "revisit", "resource"]}
    for rows in got.values():
        by = {(r.record_type, r.url): r for r in rows}
        full = by["response", "http://x/a b"]
        assert (bytes(full.payload), full.digest_ok, full.record_uri) == (BODY, True, "<urn:uuid:1>")
        assert full.content_type == "application/http; msgtype=response"
        again = by["revisit", "http://x/b"]
        assert (again.payload, again.digest_ok) == (None, None)
        assert (again.refers_to_uri, again.refers_to_url) == ("<urn:uuid:1>", "http://x/a")
        plain = by["resource", None]
        assert (bytes(plain.payload), plain.digest_ok) == (b"\r\n\r\nplain", None)
    empty = next(r for r in got["scan.wacz"] if r.url == "http://x/empty")
    assert (bytes(empty.payload), empty.digest_ok) == (b"", False)
    whole = wp.read_located(wp.locate(df.where("member = 3"), use_index=False))
    assert [r.record_type for r in sorted(whole.collect(), key=lambda r: r.offset)] == TYPES


def test_reads_what_the_own_writer_wrote(spark, tmp_path):
    rows = [(k, f"http://x/{k}", "same " * 50 if k % 2 else f"page {k}") for k in range(9)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    marked = warc.mark_revisits(df, "page_id", "html")
    written = warc.write_archives(marked, str(tmp_path / "w"), "page_id", "url", "html", archive_bytes=900)
    paths = spark.createDataFrame(written.collect())
    found = wp.read_located(wp.locate(paths, "archive")).collect()
    assert sorted(r.url for r in found) == [u for _, u, _ in rows]
    assert sum(r.record_type == "revisit" for r in found) == 3
    assert {r.digest_ok for r in found if r.record_type == "response"} == {True}


def test_scans_hold_small_pieces_and_fail_on_cut_members():
    data = b"".join(gzip.compress(r) for r in [*RECORDS, record("resource", b"0" * 100_000)])
    read = lambda offset, length: data[offset : offset + length]
    for chunk in (1, 7, 1000, 1 << 20):
        found = list(wp.gzip_members(read, 0, len(data), chunk))
        assert [wp.decode_standard(data[a : a + n])["record_type"] for a, n in found] == [*TYPES, "resource"]
        assert sum(n for _, n in found) == len(data)
    with pytest.raises(ValueError):
        list(wp.gzip_members(read, 0, len(data) - 3))
    with pytest.raises(ValueError):
        wp.decode_standard(RECORDS[1][:-10])
    with pytest.raises(ValueError):
        wp.decode_standard(b"no record")


def test_empty_table_and_compressed_members(spark, tmp_path):
    none = spark.createDataFrame([], "path string")
    assert wp.read_located(wp.locate(none)).collect() == []
    path = str(tmp_path / "packed.wacz")
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("archive/x.warc", RECORDS[0], compress_type=zipfile.ZIP_DEFLATED)
    with pytest.raises(Exception, match="not stored"):
        wp.locate(spark.createDataFrame([(path,)], "path string")).collect()
