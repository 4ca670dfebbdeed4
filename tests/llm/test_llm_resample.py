"""Importance resampling against its definition."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

import __spark_entry__ as driver
from llm_brute import lower
from tillroll.llm import resample

PATTERN = "[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def features(text, grams=2):
    w = re.findall(PATTERN, lower(text or ""))
    return w, [" ".join(w[i : i + k]) for k in range(1, grams + 1) for i in range(len(w) - k + 1)]


def by_definition(docs, items, buckets=10_000, share=25, min_words=20, seed=7):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    parts = {d: features(t) for d, t in docs}
    s = Counter(bucket(f) for _, fs in parts.values() for f in fs)
    t = Counter(bucket(f) for x in items for f in features(x)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))
    out = {}
    for d, (w, fs) in parts.items():
        weight = sum(gain(bucket(f)) for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"{seed}:{d}".encode()).hexdigest()[:8], 16)
        out[d] = [len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None]
    fit = sorted((d for d in out if len(parts[d][0]) >= min_words), key=lambda d: (-out[d][2], d))
    for rank, d in enumerate(fit[: share * len(fit) // 100], 1):
        out[d][3] = rank
    return out


def test_crc_matrices_equal_the_library():
    rng = random.Random(1)
    texts = [bytes(rng.randrange(256) for _ in range(rng.choice([0, 1, 2, 5, 5, 17, 600]))) for _ in range(300)]
    size = np.array([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    found = resample.crc32(data, np.cumsum(size) - size, size)
    assert found.tolist() == [zlib.crc32(t) for t in texts]


def test_features_equal_the_definition():
    rng = random.Random(2)
    texts = ["".join(rng.choice("aB é0\t\n.-中_Z9  ") for _ in range(rng.randint(0, 60))) for _ in range(200)]
    texts += [None, "", ".", "one", "x" * 700 + " y " + "x" * 700]
    for grams in (1, 2, 3):
        batch = pa.RecordBatch.from_pydict({"t": pa.array(texts)})
        for _, rows, data, bounds in resample._texts(batch, 0):
            found = resample.Features(data, bounds, grams, 997)
            for i, t in enumerate(texts):
                expected = Counter(zlib.crc32(f.encode()) % 997 for f in features(t, grams)[1])
                assert Counter(found.bucket[found.text == i].tolist()) == expected


def test_long_texts_keep_their_runs():
    text = " ".join(f"w{i}" for i in range(400_000))
    batch = pa.RecordBatch.from_pydict({"t": pa.array(["a b", text, "c"])})
    n = {}
    for at, rows, data, bounds in resample._texts(batch, 0):
        found = resample.Features(data, bounds, 2, 10)
        for i in range(rows):
            n[at + i] = int((found.text == i).sum())
    assert n == {0: 3, 1: 799_999, 2: 1}


def test_registered_query_equals_the_definition(spark):
    small = "/root/testdata/sf0.001"
    read = lambda name: spark.read.parquet(f"{small}/{name}.parquet").collect()
    expected = by_definition([(r.doc_id, r.text) for r in read("documents")], [r.text for r in read("benchmark")])
    out = driver.queries()["op11_resample"](spark, small)
    assert dict(out.dtypes) == dict.fromkeys(("doc_id", "n_features", "weight", "score", "rank"), "bigint")
    found = {r.doc_id: [r.n_features, r.weight, r.score, r["rank"]] for r in out.collect()}
    assert found == expected


def test_ties_nulls_other_columns_and_empty_tables(spark):
    rng = random.Random(4)
    words = "alpha beta gamma delta epsilon zeta".split()
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 12))) for _ in range(80)] + [None, "", "?!"]
    docs = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(i, t, i * 2, "p") for i, t in docs], "doc_id long, text string, part long, rank string")
    target = spark.createDataFrame([("alpha beta alpha",), (None,)], "text string")
    out = resample.resample(df.repartition(5), target, share=50, min_words=3, buckets=64)
    assert out.columns == ["doc_id", "part", "n_words", "n_features", "weight", "score", "rank"]
    expected = by_definition(docs, ["alpha beta alpha"], 64, 50, 3)
    assert {r.doc_id: [r.n_features, r.weight, r.score, r["rank"]] for r in out.collect()} == expected
    # equal ids have one variate; equal rows share the ranks that they would have
    same = spark.createDataFrame([(1, "a b c")] * 4 + [(None, "a b c")] * 4, "doc_id long, text string")
    rows = resample.resample(same, target, share=50, min_words=1).collect()
    assert sorted(r["rank"] for r in rows if r["rank"]) == [1, 2, 3, 4]
    top = {r.doc_id for r in rows if r["rank"]}
    assert len(top) == 1
    empty = resample.resample(df.limit(0), target.limit(0))
    assert empty.collect() == []
    assert len(resample.resample(df, target.limit(0)).collect()) == len(docs)
