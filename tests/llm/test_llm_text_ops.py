"""Passages, near duplicates and benchmark windows against brute force."""

from __future__ import annotations

import random
import re
import uuid
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from llm_brute import hits, linked, lower, repeats

from tillroll.llm import common, decontaminate, jaccard, sketch, suffix_dedup
from tillroll.llm.components import components
from tillroll.llm.words import ALPHANUMERIC, ASCII_SPACE, find_words

SCHEMA = "doc_id long, text string"


# ------------------------------------------------------------------------------ words


@pytest.mark.parametrize("inside, pattern", [
    (ASCII_SPACE, "[^\x20\x09-\x0D]+"), (ALPHANUMERIC, "[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"),
])
def test_words_equal_the_pattern(inside, pattern):
    rng = random.Random(1)
    texts = [
        "".join(rng.choice("aB é0\t\n.-中 \x0b_Z9") for _ in range(rng.randint(0, 40)))
        for _ in range(200)
    ] + [None, "", " "]
    words = find_words(pa.array(texts), inside)
    for i, t in enumerate(texts):
        a, b = words.first[i], words.first[i + 1]
        assert [words.word(j).decode() for j in range(a, b)] == re.findall(pattern, lower(t or ""))
    by_hash = defaultdict(set)
    for j in range(len(words.hash)):
        by_hash[int(words.hash[j])].add(words.word(j))
    assert all(len(x) == 1 for x in by_hash.values())
    assert len(by_hash) == len(set.union(*by_hash.values()))


def test_shingles_stay_in_their_text():
    words = find_words(pa.array(["a b c", "a b", "", "c a b c"]), ASCII_SPACE)
    hashes, valid = words.shingles(2)
    assert valid.tolist() == [True, True, False, True, False, True, True, True]
    assert hashes[0] == hashes[3] == hashes[6] and hashes[1] == hashes[7]


# --------------------------------------------------------------------------- passages


def passage_texts(seed, alphabet, n=50):
    rng = random.Random(seed)
    base = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 260))) for _ in range(6)]
    some = lambda k: "".join(rng.choice(alphabet) for _ in range(rng.randint(0, k)))
    texts = [
        "".join(rng.choice(base)[rng.randint(0, 50) : rng.randint(20, 200)] + some(30) for _ in range(rng.randint(0, 4)))
        for _ in range(n)
    ]
    return texts + [None, "", "a" * 300, "a" * 300, "\x00" * 250, "\x00" * 120 + "a"]


def result(df):
    return {
        r.doc_id: (r.n_bytes, r.n_removed, len(r.removed), bytes(r.kept)) for r in df.collect()
    }


@pytest.mark.parametrize("length, seed, alphabet, piece", [
    (12, 4, "ab", 1 << 20), (20, 6, "aé中", 64), (100, 32, "abc defghij", 128),
])
def test_passages_equal_the_definition(spark, monkeypatch, length, seed, alphabet, piece):
    monkeypatch.setattr(suffix_dedup, "PIECE", piece)
    texts = passage_texts(length, alphabet)
    rows = [(3 * i - 20, t) for i, t in enumerate(texts)]
    want = dict(zip((i for i, _ in rows), repeats([(t or "").encode() for _, t in rows], length)))
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert result(suffix_dedup.remove_repeats(df, length=length, seed=seed, batch_bytes=400)) == want


def test_passages_by_the_route_for_frequent_seeds(spark, monkeypatch):
    texts = passage_texts(7, "abcd")
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA).repartition(3)
    monkeypatch.setattr(sketch, "HOT", 2)
    want = dict(enumerate(repeats([(t or "").encode() for t in texts], 16)))
    assert result(suffix_dedup.remove_repeats(df, length=16, seed=5)) == want


def test_copies_of_one_passage_are_packed_by_documents(spark):
    passage = "".join(random.Random(1).choices("abcdefghij", k=600))
    docs = spark.createDataFrame([(i, f"{i} own {passage} {i}") for i in range(300)], "r long, t string")

    def seeds(batch):
        for data, bounds, _, _ in suffix_dedup._pieces(batch, 99):
            yield suffix_dedup.runs(data, bounds, 100, 20)[3]

    flags = sketch.build_sketch(docs, seeds, 10_000, 4)
    rows = suffix_dedup._entries(docs.coalesce(1), 100, 20, 64, flags).where("kind = 0").collect()
    sizes = {r.bucket: len(np.frombuffer(r.doc, np.int64)) for r in rows}
    # one row a bucket, and one span a copy: neighbouring runs are joined
    assert len(rows) == len(sizes) <= 64 and 299 <= sum(sizes.values()) <= 330
    assert max(sizes.values()) < sum(sizes.values()) / 8
    single = suffix_dedup._entries(docs.coalesce(1), 100, 20, 64, _all_hot(flags)).where("kind = 0").collect()
    assert 299 <= sum(len(r.doc) // 8 for r in single) <= 330


def _all_hot(flags):
    flags.hot = [np.arange(flags.cells, dtype=np.uint32)] * len(flags.hot)
    return flags


def test_passages_with_clashing_columns_and_text_ids(spark):
    p = "".join(random.Random(2).choices("abcdefghij", k=200))
    names = ["doc", "open", "gone", "r", "t", "c0", "owner", "spans", "_text", "_row"]
    df = spark.createDataFrame(
        [("b", p, *range(10)), ("a", p + "x", *range(10, 20)), (None, p, *range(20, 30))],
        "id string, body string, " + ", ".join(f"{n} int" for n in names),
    )
    out = suffix_dedup.remove_repeats(df, "id", "body", digest=True)
    assert out.columns == ["id", *names, "n_bytes", "n_removed", "removed", "kept", "kept_sha256"]
    got = {r.id: r for r in out.collect()}
    # the order of ids decides: the text of "a" stays, nulls come last
    assert {k: r.n_removed for k, r in got.items()} == {"a": 0, "b": 200, None: 200}
    assert [got["b"][n] for n in names] == list(range(10))


def test_passages_of_few_long_documents(spark, monkeypatch):
    rng = random.Random(4)
    line = "".join(rng.choices("abcdefgh", k=40))
    texts = ["".join(line + "".join(rng.choices("abcdefgh", k=9)) for _ in range(300)) for _ in range(5)]
    monkeypatch.setattr(sketch, "HOT", 100)  # counted over all documents, however few
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    want = dict(enumerate(repeats([t.encode() for t in texts], 30)))
    assert result(suffix_dedup.remove_repeats(df, length=30, seed=12)) == want


def test_passages_of_rows_with_null_and_equal_ids(spark):
    rng = random.Random(0)
    p = "".join(rng.choice("abcdefgh") for _ in range(150))
    rows = [(None, p), (None, p), (5, p + "x"), (5, p + "x"), (5, "y" + p), (9, p)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = suffix_dedup.remove_repeats(df).collect()
    # in the order of (id, nulls last, text): the first one stays whole
    assert sorted((r.doc_id or 99, r.n_bytes - r.n_removed) for r in got) == [
        (5, 0), (5, 1), (5, 151), (9, 0), (99, 0), (99, 0)
    ]


def test_passages_keep_whole_characters_and_other_columns(spark):
    p = "é" * 80 + "".join(map(chr, range(97, 123)))
    rows = [(1, p, 7, "k"), (2, "è" + p[1:], 8, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_bytes int, kept string")
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(df, text=True, length=30, seed=8).collect()}
    assert got[1].text.startswith("é") and got[2].text == "è" and got[2].n_bytes == len(p.encode())
    assert set(got[1].asDict()) == {"doc_id", "n_bytes", "n_removed", "removed", "kept", "text"}


def test_passages_of_an_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert suffix_dedup.remove_repeats(df).collect() == []


def test_suffix_levels_are_logarithmic():
    rng = np.random.default_rng(0)
    levels = suffix_dedup.SuffixLevels(20)
    for _ in range(64):
        levels.add(rng.integers(0, 256, 119, np.uint8), np.arange(100))
    sizes = [len(x) for x in levels.levels]
    assert sum(sizes) == 6400 and len(sizes) <= 7
    assert all(a > 2 * b for a, b in zip(sizes, sizes[1:]))


# --------------------------------------------------------------------- near duplicates


def near_copies(seed, groups=10):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(250)]
    texts = []
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 8, 30, 100, 300]))]
        for _ in range(rng.randint(1, 20)):
            t = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 40))):
                t[rng.randrange(len(t))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                t = t[rng.randint(0, len(t) // 8) :]
            texts.append(" ".join(t) if rng.random() < 0.9 else "\t".join(t).upper())
    texts += [None, "", " \n ", "a b", "A b", "a b c"]
    rng.shuffle(texts)
    return [(2 * i, t) for i, t in enumerate(texts)]


def joined(df):
    return {r.doc_id: (r.n_shingles, r.component) for r in jaccard.join(df).collect()}


@pytest.mark.parametrize("leaf, frequent", [(32, 64), (2, 0)])
def test_links_equal_brute_force(spark, monkeypatch, leaf, frequent):
    monkeypatch.setattr(jaccard, "LEAF", leaf)
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    rows = near_copies(leaf)
    assert joined(spark.createDataFrame(rows, SCHEMA).repartition(3)) == linked(rows)


def test_links_of_a_large_group_by_salted_verification(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "MEMBERS_PER_TASK", 3)
    base = [f"t{i}" for i in range(60)]
    rows = [(i, " ".join(base[: 50 + i % 10] + [f"own{i}"])) for i in range(40)]
    assert joined(spark.createDataFrame(rows, SCHEMA)) == linked(rows)


def test_links_of_unusual_tables(spark):
    assert joined(spark.createDataFrame([], SCHEMA)) == {}
    t = "one two three four five six"
    rows = [(None, t), (4, t), (4, t), (6, None), (6, None), (8, "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r.doc_id or -1, r.n_shingles, r.component) for r in jaccard.join(df).collect())
    assert got == [(-1, 2, 4), (4, 2, 4), (4, 2, 4), (6, 0, 6), (6, 0, 6), (8, 1, 8)]
    first = jaccard.representatives(df.selectExpr("*", "1 AS n", "2 AS doc")).collect()
    assert sorted((r.doc_id or -1, r.text or "", r.n, r.doc) for r in first) == [
        (4, t, 1, 2), (6, "", 1, 2), (6, "", 1, 2), (8, "x", 1, 2)
    ]


def test_tree_leaves_exactly_what_the_bound_leaves():
    rng = np.random.default_rng(3)
    centres = rng.poisson(3, (9, jaccard.GROUPS))
    points = (centres[rng.integers(0, 9, 500)] + rng.poisson(0.2, (500, jaccard.GROUPS))).astype(np.uint32)
    n = points.sum(1).astype(np.int64)
    group = rng.integers(0, 3, 500)
    i, j = np.triu_indices(500, 1)
    keep = (group[i] != group[j]) & (
        jaccard.overlap_bound(points, i, j) >= jaccard.need(n[i], n[j])
    ) & (4 * np.minimum(n[i], n[j]) >= 3 * np.maximum(n[i], n[j]))
    want = set(zip(i[keep].tolist(), j[keep].tolist()))
    tree = jaccard.CountTree(points, n, group, np.ones(500, bool), np.ones(500, bool))
    got = {(min(a, b), max(a, b)) for x, y in tree.self_join() for a, b in zip(x.tolist(), y.tolist())}
    assert want <= got
    assert {p for p in got if 4 * min(n[list(p)]) >= 3 * max(n[list(p)])} == want

    lead, probe = rng.random(500) < 0.1, rng.random(500) < 0.7
    some = jaccard.CountTree(points, n, group, lead, probe)
    got_some = {(min(a, b), max(a, b)) for x, y in some.self_join() for a, b in zip(x.tolist(), y.tolist())}
    assert got_some == {(a, b) for a, b in got if lead[a] and probe[b] or lead[b] and probe[a]}


def test_partners_of_a_block_equal_the_bounds():
    rng = np.random.default_rng(5)
    key = np.sort(rng.integers(0, 60, 900))
    n, doc = rng.integers(1, 60, 900).astype(np.int32), np.arange(900)
    rank = (rng.random(900) * jaccard.probe_prefix(n)).astype(np.int32)
    want = np.zeros(900, bool)
    for i in range(900):
        for j in range(900):
            small, large = (i, j) if n[i] <= n[j] else (j, i)
            if i != j and key[i] == key[j] and 4 * n[small] >= 3 * n[large]:
                leads = rank[small] < jaccard.index_prefix(int(n[small]))
                leads |= n[i] == n[j] and rank[large] < jaccard.index_prefix(int(n[large]))
                want[i] |= leads
    assert (jaccard._has_partner(key, n, rank) == want).all()


def test_documents_of_one_template_leave_their_block():
    """Shared shingles that stand in no index prefix leave no row of the block."""
    rows = 20_000
    key = np.zeros(rows, np.int64)
    n, rank = np.full(rows, 40, np.int32), np.full(rows, 10, np.int32)
    assert not jaccard._has_partner(key, n, rank).any()


@pytest.mark.parametrize("rows, held", [(3, 4), (7, 65_536)])
def test_links_by_cells_of_split_blocks(spark, monkeypatch, rows, held):
    monkeypatch.setattr(jaccard, "LEAF", 2)
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", rows)
    monkeypatch.setattr(jaccard, "HELD_ROWS", held)
    monkeypatch.setattr(jaccard, "FREQUENT", 0)
    split, seen = jaccard._split, []
    monkeypatch.setattr(jaccard, "_split", lambda df: seen.append(1) or split(df))
    texts = near_copies(rows, groups=6)
    frame = [f"c{i}" for i in range(40)]  # one template, some of its documents linked
    texts += [(1000 + i, " ".join(frame[: 30 + i % 11] + [f"v{i % 9}", f"u{i % 5}"])) for i in range(60)]
    assert joined(spark.createDataFrame(texts, SCHEMA).repartition(3)) == linked(texts)
    assert seen


def test_components_of_chains_rings_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100 + i, 100) for i in range(30)] + [(7, 7), (200, 201), (201, 200)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "u long, v long")).collect()))
    want = {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {200: 200, 201: 200}
    assert got == want
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def _tasks(spark, job):
    """What ``job`` returns, and the tasks it took with 30 partitions a shuffle."""
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = [spark.conf.get(n, None) for n in names]
    group = f"count-{uuid.uuid4().hex}"
    for name, value in zip(names, ("30", "false")):
        spark.conf.set(name, value)
    spark.sparkContext.setJobGroup(group, "")
    try:
        out = job()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for name, value in zip(names, before):
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    tracker, total = spark.sparkContext.statusTracker(), 0
    for j in tracker.getJobIdsForGroup(group):
        for s in tracker.getJobInfo(j).stageIds:
            info = tracker.getStageInfo(s)
            total += info.numCompletedTasks if info else 0
    return out, total


@pytest.mark.parametrize("limit", [None, 0])
def test_few_links_take_few_tasks_and_many_the_same_steps(spark, monkeypatch, limit):
    if limit is not None:
        monkeypatch.setattr(common, "FEW_ROWS", limit)
    # a chain, a ring and a star, then a group of more copies than one task's centre takes
    edges = [(i, i + 1) for i in range(30)] + [(100 + i, 100 + (i + 1) % 9) for i in range(9)]
    edges += [(200, 201 + i) for i in range(40)]
    df = spark.createDataFrame(edges, "u long, v long")
    got, tasks = _tasks(spark, lambda: dict(map(tuple, components(df).collect())))
    assert got == {i: 0 for i in range(31)} | {100 + i: 100 for i in range(9)} | {200 + i: 200 for i in range(41)}
    many, lead = limit is not None, "a b c d e f g h i j k l m n o p "
    assert many or tasks < 200  # a thousand when each key of a round was dealt out
    texts = [(i, lead * 2 + f"tail {i}") for i in range(300)] + [(400 + i, f"other {i} " * 9) for i in range(9)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    pairs = spark.createDataFrame([(0, i) for i in range(1, 300)] + [(400, 401)], "a long, b long")
    values = docs.selectExpr("doc_id AS id", "cast(text AS binary) AS value")
    near = lambda: jaccard._compare(
        pairs, values, 30, lambda x: [v[:9] for v in x.to_pylist()], lambda x, y: x == y
    ).collect()
    rows, tasks = _tasks(spark, near)
    assert sorted(map(tuple, rows)) == [(0, i) for i in range(1, 300)]
    assert many or tasks < 120


# ------------------------------------------------------------------------ benchmark


def test_windows_equal_brute_force(spark):
    rng = random.Random(4)
    vocabulary = ["the", "of", "a", "x1", "é", "中文", "zz"]
    some = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k))
    items = [(i, some(rng.choice([1, 2, 3, 9, 10, 11, 25]))) for i in range(25)]
    items += [(3, items[3][1]), (90, items[4][1]), (None, some(12)), (91, None), (92, " .. ")]
    docs = []
    for i in range(80):
        t = some(rng.randint(0, 12)) + ", " + (rng.choice(items)[1] or "") + "! " + some(rng.randint(0, 9))
        docs.append((i, t.upper() if i % 7 == 0 else t))
    docs += [(500, None), (501, ""), (502, "...")]
    want = hits(docs, items)
    df = spark.createDataFrame(docs, SCHEMA).selectExpr("*", "'k' AS n_hit", "7 AS other").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    for limit in (1 << 20, 150):  # one slice, and several
        found = decontaminate.find_contamination(df, bench, slice_bytes=limit).collect()
        assert {r.doc_id: (r.n_words, r.n_hit, list(r.item_ids)) for r in found} == want
        assert all(r.n_hit == sum(s["last"] - s["first"] + 1 for s in r.hit_spans) and r.other == 7 for r in found)
        assert {r.doc_id: r.text for r in found} == dict(docs)


def test_windows_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], SCHEMA)
    none = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r) for r in decontaminate.find_contamination(docs, none).collect()] == [(1, "a b", 2, 0, [], [])]
    bench = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert decontaminate.find_contamination(docs.limit(0), bench).collect() == []
