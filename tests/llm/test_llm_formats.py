"""Archives, tokens, licences and top-k."""

from __future__ import annotations

import hashlib
import io
import random
import zipfile

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tillroll.llm import bpe, licenses, topk, warc
from tillroll.llm.common import stored, work_dir

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


# ---------------------------------------------------------------------------- archives


def ranges(data):
    return warc.ZipRanges(lambda offset, length: data[offset : offset + length], len(data))


@pytest.mark.parametrize("zip64", [False, True])
def test_zip_directory(zip64):
    members = [("a/x", b"one" * 50), ("b", b""), ("é", b"PK\x05\x06 in the data")]
    data = warc.build_zip(members, zip64)
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        assert z.testzip() is None and [(n, z.read(n)) for n in z.namelist()] == members
    package = ranges(data)
    assert [(m.name, package.read(m)) for m in package.members.values()] == members


def test_zip_of_another_writer():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("stored", b"abc")
        z.writestr("packed", b"abc" * 99, compress_type=zipfile.ZIP_DEFLATED)
        with z.open("big", "w", force_zip64=True) as f:
            f.write(b"x" * 10)
        z.comment = b"a comment PK\x05\x06 with a signature"
    package = ranges(out.getvalue())
    assert package.read(package.members["stored"]) == b"abc"
    assert package.read(package.members["big"]) == b"x" * 10
    with pytest.raises(ValueError):
        package.start(package.members["packed"])
    with pytest.raises(ValueError):
        ranges(b"no archive")


def test_record_round_trip():
    payload = "é\r\n\r\nWARC/1.1\r\n".encode()
    digest = hashlib.sha256(payload).hexdigest()
    url = "http://x/ä%20 b\r\nEvil: 1"
    r = warc.decode_record(warc.encode_record(7, url, payload, digest, None, "2020-01-01T00:00:00Z"))
    assert (r["record_id"], r["url"], r["payload"], r["record_type"]) == (7, url, payload, "response")
    r = warc.decode_record(warc.encode_record(8, None, payload, digest, 7, "2020-01-01T00:00:00Z"))
    assert (r["url"], r["payload"], r["refers_to"], r["payload_bytes"]) == (None, None, 7, len(payload))
    with pytest.raises(ValueError):
        warc.decode_record(warc.encode_record(7, url, payload, "0" * 64, None, "2020-01-01T00:00:00Z"))


def archived(spark, df, **options):
    marked = warc.mark_revisits(df, "page_id", "html")
    written = warc.write_archives(marked, work_dir(spark, "t"), "page_id", "url", "html", **options)
    manifest = stored(written, "t-manifest")
    return manifest, warc.read_records(warc.read_index(manifest, block=2))


@pytest.mark.parametrize("zip64", [None, True])
def test_archives(spark, zip64):
    long = "x" * 99 + "é"
    rows = [(5, "u5", long), (3, "u3", long), (4, None, long), (9, "u9", "short"), (2, "u2", "short"),
            (7, "", None), (7, "u", ""), (None, "n", long), (3, "again", long), (11, "é b", "y" * 100)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "1 AS payload", "2 AS _n"
    ).repartition(3)
    manifest, records = archived(spark, df, archive_bytes=600, zip64=zip64)
    got = sorted(
        ((r.record_id, r.url, r.record_type, r.payload_bytes, r.refers_to, r.payload) for r in records.collect()),
        key=repr,
    )
    assert sum(r.n_records for r in manifest.collect()) == len(rows)
    first = lambda i, t: t and len(t.encode()) >= 100 and t == long and i != 3
    want = sorted((
        (i, u, "revisit" if first(i, t) else "response", len((t or "").encode()),
         3 if first(i, t) else None, None if first(i, t) else (t or "").encode())
        for i, u, t in rows), key=repr)
    assert got == want


def test_archives_of_an_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    manifest, records = archived(spark, df)
    assert manifest.collect() == [] and records.collect() == []


# ------------------------------------------------------------------------------ tokens


@pytest.fixture(scope="module")
def pair():
    ranks = bpe.read_ranks(PATH)
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return bpe.Codec(ranks, public_tokenizers.PATTERN), library


def test_perfect_hash_is_minimal():
    keys = [f"key{i}".encode() for i in range(3000)] + [b""]
    h = bpe.PerfectHash(keys)
    assert sorted(map(h, keys)) == list(range(len(keys)))
    assert 0 <= h(b"other") < len(keys)
    assert bpe.PerfectHash([b"one"])(b"one") == 0


def test_ids_equal_the_library(pair):
    codec, library = pair
    rng = random.Random(2)
    alphabet = "abe tion  \n\t  é中0 1²Ⅷ'slIl!?<|endoftext|>\x1c\U0001f600"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 120))) for _ in range(400)]
    texts += ["<|endoftext|>", "x" * 5000, "é" * 3000, " " * 3000 + "a", "'ll 've 'LL", ""]
    for t in texts:
        packed = codec.encode(t)
        assert np.frombuffer(packed, "<u4").tolist() == library.encode_ordinary(t)
        assert codec.decode(packed) == t.encode()


def test_merges_of_every_length(pair):
    codec, library = pair
    rng = random.Random(3)
    for n in range(1, 60):
        piece = "".join(rng.choice("abcdetion") for _ in range(n)).encode()
        assert bpe.merge(piece, codec.ranks) == library.encode_ordinary(piece.decode())


def test_full_memo_is_emptied(pair, monkeypatch):
    codec, library = pair
    monkeypatch.setattr(bpe, "MEMO_ENTRIES", 3)
    text = " ".join(f"word{i}" for i in range(50))
    assert np.frombuffer(codec.encode(text), "<u4").tolist() == library.encode_ordinary(text)


def test_token_columns(spark, pair):
    _, library = pair
    rows = [(1, "a b", "k"), (1, "a b", "k"), (None, None, None), (3, "", "é"), (4, "中文 " * 9, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string").withColumn("_text2", F.lit(1))
    coded = bpe.encode(df, PATH, public_tokenizers.PATTERN, digests=True)
    got = sorted((r.doc_id or 0, list(r.ids), r.n_tokens) for r in coded.collect())
    want = sorted((i or 0, library.encode_ordinary(t or ""), len(library.encode_ordinary(t or ""))) for i, t, _ in rows)
    assert got == want
    back = bpe.decode(coded, PATH, public_tokenizers.PATTERN).collect()
    assert sorted((r.doc_id or 0, bytes(r.decoded)) for r in back) == sorted((i or 0, (t or "").encode()) for i, t, _ in rows)
    assert all(hashlib.sha256(r.decoded).hexdigest() == r.decoded_sha256 for r in back)
    assert bpe.encode(df.limit(0), PATH, public_tokenizers.PATTERN).collect() == []


# ---------------------------------------------------------------------------- licences

MIT, APACHE = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
FILES = [
    ("a/LICENSE", "text\n" + MIT), ("a/x.py", "code"), ("a/b/y.py", "code\n# " + APACHE),
    ("a/b/z.py", None), ("a/b/c/COPYING.txt", APACHE), ("a/b/c/d/e/w.py", ""), ("a/b/c/v.py", "v"),
    ("ab/u.py", "u"), ("LICENSE.bak/q", "q"), ("top.py", "t"), (None, MIT), (None, None),
    ("a/s.py", "a license of no known kind but with many words about other things"),
    ("g/NOTICE", "nothing"), ("g/h.py", "h"), ("a/x.py", "code"),
]


def test_licences_and_inheritance(spark):
    df = spark.createDataFrame(FILES, "path string, text string").withColumn("score", F.lit("clash"))
    out = licenses.scan(df, licenses.templates(spark))
    got = {(r.path, r.license_id, r.origin, r.license_path) for r in out.collect()}
    copying = "a/b/c/COPYING.txt"
    assert out.count() == len(FILES)
    assert got == {
        ("a/LICENSE", "MIT", "own", "a/LICENSE"), ("a/x.py", "MIT", "inherited", "a/LICENSE"),
        ("a/b/y.py", "Apache-2.0", "own", "a/b/y.py"), ("a/b/z.py", "MIT", "inherited", "a/LICENSE"),
        (copying, "Apache-2.0", "own", copying), ("a/b/c/d/e/w.py", "Apache-2.0", "inherited", copying),
        ("a/b/c/v.py", "Apache-2.0", "inherited", copying), ("ab/u.py", None, None, None),
        ("LICENSE.bak/q", None, None, None), ("top.py", None, None, None), (None, None, None, None),
        ("a/s.py", "MIT", "inherited", "a/LICENSE"), ("g/NOTICE", None, None, None), ("g/h.py", None, None, None),
    }


def test_licence_of_the_top_directory(spark):
    df = spark.createDataFrame([("LICENSE", MIT), ("x", ""), ("d/e/f", "")], "path string, text string")
    got = {r.path: r.license_id for r in licenses.scan(df, licenses.templates(spark)).collect()}
    assert got == {"LICENSE": "MIT", "x": "MIT", "d/e/f": "MIT"}
    assert licenses.scan(df.limit(0), licenses.templates(spark)).collect() == []
    assert {r.license_id for r in licenses.scan(df, licenses.templates(spark).limit(0)).collect()} == {None}


def test_every_template_names_itself(spark):
    df = spark.createDataFrame([(k, f"# {v}") for k, v in licenses.TEMPLATES], "path string, text string")
    got = {r.path: (r.license_id, r.score) for r in licenses.scan(df, licenses.templates(spark)).collect()}
    assert all(k == name and abs(score - 1) < 1e-6 for k, (name, score) in got.items())


HEADERS = {
    "// SPDX-License-Identifier: MIT": "MIT",
    "# SPDX-License-Identifier: Apache-2.0": "Apache-2.0",
    "/* SPDX-License-Identifier: GPL-3.0-or-later */": "GPL-3.0",
    "/* SPDX-License-Identifier: (GPL-2.0-only WITH Linux-syscall-note) OR Zlib OR X11 */": "GPL-2.0",
    "# SPDX-License-Identifier: BSD-2-Clause": "BSD-2-Clause",
    "# SPDX-License-Identifier: Zlib": None,
    "Mozilla Public License Version 2.0": "MPL-2.0", "Mozilla Public License Version 1.1": "MPL-1.1",
    "BSD 3-Clause License": "BSD-3-Clause", "BSD 2-Clause License": "BSD-2-Clause",
    "# This file came with the tool of that name. Licensed under the MIT License. Ask its first "
    "author, who wrote it long ago, about every other question that you may have.": "MIT",
    "# This Source Code Form is subject to the terms of the Mozilla Public\n# License, v. 2.0. If a copy of "
    "the MPL was not distributed with this\n# file, You can obtain one at http://mozilla.org/MPL/2.0/.": "MPL-2.0",
    " * This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU "
    "General Public License as published by\n * the Free Software Foundation, either version 3 of the License, "
    "or\n * (at your option) any later version.": "GPL-3.0",
    " * This program is free software; you can redistribute it and/or\n * modify it under the terms of the GNU "
    "General Public License\n * as published by the Free Software Foundation; either version 2\n * of the "
    "License, or (at your option) any later version.": "GPL-2.0",
    "He lost his driver's license on the way to the sea, and nobody there asked for it.": None,
}


def test_headers_that_are_no_templates(spark):
    rows = [(f"{i}/x.c", text) for i, text in enumerate(HEADERS)]
    df = spark.createDataFrame(rows, "path string, text string")
    got = {r.path: r.license_id for r in licenses.scan(df, licenses.templates(spark)).collect()}
    assert {t: got[f"{i}/x.c"] for i, t in enumerate(HEADERS)} == HEADERS


def test_whole_licence_files(spark):
    rows = []
    for name, text in licenses.texts():  # another holder, other line breaks, a part cut off
        words = ("Copyright (c) 2031 Some Body and others\n\n" + text).split()
        words = words[: len(words) * 9 // 10]
        rows.append((f"{name}/LICENSE", "\n".join(" ".join(words[i : i + 9]) for i in range(0, len(words), 9))))
    prose = " ".join(["the end of the license and of the rights to it, as any of them said,"] * 300)
    df = spark.createDataFrame([*rows, ("prose/LICENSE", prose)], "path string, text string")
    got = {r.path: r.license_id for r in licenses.scan(df, licenses.templates(spark)).collect()}
    assert got == {p: p.split("/")[0] for p, _ in rows} | {"prose/LICENSE": None}


def test_licence_plan_has_no_python(spark):
    df = spark.createDataFrame(FILES, "path string, text string")
    plan = licenses.scan(df, licenses.templates(spark))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct"))


# ------------------------------------------------------------------------------- top-k


def brute_top_k(rows, k):
    good = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            good.append((i, [int(np.floor(64.0 * float(np.float32(x)))) for x in v]))
    out = []
    for q, x in good:
        if q % 20 == 0:
            best = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in good if i != q and len(x) == len(y))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best[:k])]
    return sorted(out)


@pytest.mark.parametrize("scale", [0.05, 1.0, 3e4])
def test_top_k(spark, scale):
    rng = np.random.default_rng(1)
    x = rng.normal(0, scale, (300, 12)).astype(np.float32)
    rows = [(i - 40, [float(v) for v in x[i // 2]]) for i in range(300)]  # every vector twice: ties
    rows += [(None, rows[0][1]), (1000, None), (1020, [None] * 12), (1040, [float("nan")] * 12),
             (1060, [1.0] * 11 + [float("inf")]), (1080, [1.0, 2.0]), (1081, [0.5, 0.25]), (1100, []), (1101, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS score")
    got = topk.top_k(df, F.col("vec_id") % 20 == 0, vectors_per_block=64, queries_per_block=4)
    assert sorted(map(tuple, got.collect())) == brute_top_k(rows, 20)


def test_top_k_of_repeated_rows_and_empty_tables(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk.top_k(df, F.col("vec_id") == 0, k=3).collect()
    assert [(r["rank"], r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"])] == [
        (1, 1, 4096), (2, 1, 4096), (3, 2, 0)
    ]
    assert topk.top_k(df.limit(0), F.col("vec_id") == 0).collect() == []


def test_top_k_of_many_query_blocks(spark):
    n = 2060  # a block per query: block numbers start with the partition, up to 2,059 here
    rows = [(i, [float(i % 7), float(i % 5)]) for i in range(n)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk.top_k(df, F.lit(True), k=1, queries_per_block=1).collect()
    assert len(got) == n and {r.query_id for r in got} == set(range(n))
    best = {i: min((-64 * 64 * (a * (j % 7) + b * (j % 5)), j) for j in range(35 * 2) if j != i)
            for i, (a, b) in rows}
    assert {r.query_id: (-r.score, r.vec_id) for r in got} == best


def test_block_reads_few_exact_vectors():
    rng = np.random.default_rng(5)
    exact = rng.integers(-20, 20, (5000, 32)).astype(np.int16)
    exact[:40] = 15
    ids = np.arange(5000)
    read = []

    class Counted(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, np.ndarray):
                read.append(len(key))
            return super().__getitem__(key)

    found = list(topk.block_top_k(
        np.array([-1]), np.full((1, 32), 15), ids, np.floor_divide(exact, 4).astype(np.int8),
        exact.view(Counted), 4, 20,
    ))
    assert found[0][1].tolist() == list(range(20)) and sum(read) < 500
