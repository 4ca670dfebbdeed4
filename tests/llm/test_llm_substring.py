"""Repeated word windows against the definition."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as driver
from tillroll.llm import sketch, substring
from tillroll.llm.words import ASCII_SPACE, blocks, find_words

SCHEMA = "doc_id long, text string"


def by_definition(texts, window):
    """(words, removed, kept text) of each text."""
    words = [re.findall("[^\x20\x09-\x0D]+", t or "") for t in texts]
    count = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def corpus(seed, vocabulary, n=60):
    rng = random.Random(seed)
    word = lambda: rng.choice(vocabulary)
    some = lambda k: [word() for _ in range(k)]
    passages = [some(rng.randint(5, 60)) for _ in range(6)]
    texts = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(0, 5)):
            parts += rng.choice(passages)[rng.randint(0, 3) :] if rng.random() < 0.5 else some(rng.randint(1, 40))
        texts.append(rng.choice([" ", "\n", " \t "]).join(parts))
    return texts + [None, "", " ", texts[1], texts[1], "a " * 200, "é中 " * 50]


def checked(spark, texts, window, partitions=4, **kw):
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    found = {
        r.doc_id: r for r in substring.remove_windows(
            df, window=window, columns=("n_words", "n_removed", "removed", "kept", "kept_sha256"), **kw
        ).collect()
    }
    assert len(found) == len(texts)
    for i, (n, gone, kept) in enumerate(by_definition(texts, window)):
        r = found[i]
        assert (r.n_words, r.n_removed, r.kept) == (n, gone, kept), i
        assert r.kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()
        assert sum(x["last"] - x["first"] + 1 for x in r.removed) == gone


@pytest.mark.parametrize("window, gram, seed, vocabulary", [
    (8, 4, 1, "a b c d e f g h i j k l m n o p".split()),
    (6, 3, 2, "x y".split()),
    (35, None, 3, "the of and to in is that for it was on".split()),
    (1, None, 4, "a b c d e f g h i j k l m n o p q r s t u v w x y z".split()),
])
def test_windows_equal_the_definition(spark, window, gram, seed, vocabulary):
    checked(spark, corpus(seed, vocabulary), window, gram=gram)


def test_a_full_sketch_and_frequent_anchors_change_nothing(spark, monkeypatch):
    texts = corpus(5, "a b c d e f".split())
    monkeypatch.setattr(sketch, "MAX_CELLS", 8)
    monkeypatch.setattr(sketch, "BLOCK", 8)
    checked(spark, texts, 7, gram=3)
    monkeypatch.setattr(sketch, "MAX_CELLS", 1 << 16)
    monkeypatch.setattr(sketch, "BLOCK", 1 << 12)
    monkeypatch.setattr(sketch, "HOT", 5)
    monkeypatch.setattr(substring, "POOL", 64)
    checked(spark, texts, 7, gram=3)


def test_a_common_line_in_varying_surroundings(spark, monkeypatch):
    rng = random.Random(9)
    line = "one very common line of exactly ten words in all".split()
    texts = [
        " ".join([f"w{rng.random()}" for _ in range(20)] + line + [f"v{rng.random()}" for _ in range(20)])
        for _ in range(300)
    ]
    monkeypatch.setattr(sketch, "HOT", 50)
    checked(spark, texts + texts[:3], 12, gram=6)


def test_long_texts_are_hashed_in_parts():
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["ab", "c", "long" * 9]) for _ in range(rng.randint(0, 400))) for _ in range(30)]
    texts += ["x" * 500, None, "", " y "]
    batch = pa.RecordBatch.from_pydict({"r": pa.array(range(len(texts))), "t": pa.array(texts)})
    found = {}
    for at, rows, data, bounds in blocks(batch.column(1), ASCII_SPACE, 100):
        assert len(data) <= 100 or ASCII_SPACE[data[100:]].all()
        found.setdefault(at, []).append(data.tobytes())
    for i, t in enumerate(texts):
        if len((t or "").encode()) > 100:
            assert b"".join(found[i]) == t.encode()
    whole = find_words(batch.column(1), ASCII_SPACE)
    split = {}
    import tillroll.llm.substring as module

    for at, rows, codes, first in module._sequences(batch, 1):
        for i in range(rows):
            split[at + i] = codes[first[i] : first[i + 1]]
    fold = [x for x in whole.hash]
    assert np.array_equal(np.concatenate([split[i] for i in range(len(texts))]), np.array(fold))


def test_other_columns_names_ids_and_empty_tables(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [("x", passage, 1, "a"), ("x", passage + " end", 2, "b"), (None, None, 3, "c"), (None, passage, 4, "d"),
            ("y", "short", None, None)]
    df = spark.createDataFrame(rows, "doc_id string, t string, owner int, spans string")
    out = substring.remove_windows(df, text_col="t", columns=("n_words", "n_removed", "kept"))
    assert out.columns == ["doc_id", "owner", "spans", "n_words", "n_removed", "kept"]
    got = sorted((r.owner or 0, r.doc_id, r.spans, r.n_words, r.n_removed, r.kept) for r in out.collect())
    assert got == [
        (0, "y", None, 1, 0, "short"), (1, "x", "a", 40, 40, ""), (2, "x", "b", 41, 40, "end"),
        (3, None, "c", 0, 0, ""), (4, None, "d", 40, 40, ""),
    ]
    same = spark.createDataFrame([(1, passage), (1, passage), (2, "a")], SCHEMA)
    assert sorted(r.n_removed for r in substring.remove_windows(same).collect()) == [0, 40, 40]
    assert substring.remove_windows(df.limit(0), text_col="t").collect() == []


def test_registered_query_equals_the_definition(spark):
    small = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    expected = dict(zip((r.doc_id for r in rows), by_definition([r.text for r in rows], 35)))
    found = driver.queries()["op13_substring"](spark, small).collect()
    assert len(found) == len(rows) and any(r.n_removed for r in found)
    for r in found:
        n, gone, kept = expected[r.doc_id]
        assert (r.n_words, r.n_removed) == (n, gone)
        assert r.kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()
