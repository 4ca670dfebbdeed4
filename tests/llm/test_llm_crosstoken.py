"""Alignment of two tokenizers against whole-text encodings by their libraries."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers as files
import sentencepiece
from tokenizers import Tokenizer

import __spark_entry__ as driver
from tillroll.llm import crosstoken

A, B = files.path("byte_bpe_50k.json"), files.path("piece_bpe_32k.model")
ADDED = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def by_definition(texts):
    a, b = libraries()
    letters = crosstoken._byte_alphabet()
    rows, counts = [], Counter()
    for text in texts:
        row = None
        if text:
            ia = a.encode(" " + text, add_special_tokens=False).ids
            ib = b.encode(text)
            ta = [bytes(letters[c] for c in a.id_to_token(i)) for i in ia]
            tb = [
                bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i)
                else b.id_to_piece(i).replace("▁", " ").encode() for i in ib
            ]
            if b"".join(ta) == b"".join(tb) == (" " + text).encode():
                row = (ia, ib, ta, tb)
        if row is None:
            rows.append(None)
            continue
        # the token of either side that each byte belongs to
        of_a, of_b = ([i for i, t in enumerate(ts) for _ in t] for ts in (ta, tb))
        met = list(dict.fromkeys(zip(of_a, of_b)))
        linked = [(ia[i], ib[j]) for i, j in met]
        groups, before = [], (-1, -1)
        for at, (i, j) in enumerate(zip(of_a, of_b)):
            if at + 1 == len(of_a) or (of_a[at + 1] != i and of_b[at + 1] != j):
                groups.append((ia[before[0] + 1 : i + 1], ib[before[1] + 1 : j + 1]))
                before = i, j
        counts.update(linked)
        shown = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        rows.append((len(ia), len(ib), len(groups), linked, shown))
    best = defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return [
        (0, 0, 0, 0, 0, 0, "") if r is None else (
            *r[:3], len(r[3]), sum(counts[p] == best[p[1]] for p in r[3]), sum(counts[p] for p in r[3]),
            hashlib.sha256(r[4].encode()).hexdigest(),
        ) for r in rows
    ]


def odd_texts():
    rng = random.Random(1)
    signs = list("aAe  \n\t.,'\"-éß中語🙂 　́​\x1f\x85▁Ω1 9") + [
        " the", "ing", "  ", " \n", "\n\n ", "'s", "n't", "<|endoftext|>", "<0x41>", "</s>", "http://x.y/z?q=1",
    ]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 30))) for _ in range(400)]
    texts += [" ", "  ", "\n", "a ", " a", "a  b", "a \n b", "a\n  b\n", "x" * 3000, "no blanks," * 200, "▁a", None, ""]
    return texts + ["the same text", "the same text", "end​ of", "tab\t and"]


def test_cuts_equal_the_common_ends():
    rng = random.Random(2)
    for _ in range(500):
        n = rng.randint(1, 40)
        a = sorted({*rng.sample(range(1, n + 1), rng.randint(1, n)), n})
        b = sorted({*rng.sample(range(1, n + 1), rng.randint(1, n)), n})
        cuts = crosstoken.shared_cuts(a, b)
        assert [a[p - 1] for p, _ in cuts] == sorted(set(a) & set(b)) == [b[q - 1] for _, q in cuts]
        starts = lambda e: [0, *e[:-1]]
        expected = [
            (i, j) for i, (s, e) in enumerate(zip(starts(a), a)) for j, (p, q) in enumerate(zip(starts(b), b))
            if s < q and p < e
        ]
        assert sorted(crosstoken.links(a, b, cuts)) == expected


def test_no_cut_is_searched_twice():
    a = list(range(2, 20_002, 2))
    b = [*range(1, 20_000, 2), 20_000]  # the only shared end is the last
    assert crosstoken.shared_cuts(a, b) == [(len(a), len(b))]


def test_parts_equal_whole_texts():
    with open(A, encoding="utf-8") as fa, open(B, "rb") as fb:
        json_a, model_b = fa.read(), fb.read()
    a, b = libraries()
    for pattern in (files.PATTERN, None):
        aligner = crosstoken.Aligner(json_a, model_b, pattern)
        # texts with U+2581 have no tokens: B takes it for a blank
        for text in [t for t in odd_texts() if t and "\u2581" not in t]:
            parts = aligner.parts(text)
            assert " " + " ".join(parts) == " " + text
            assert [i for p in parts for i in aligner.encode_a(" " + p)] == a.encode(" " + text, add_special_tokens=False).ids, repr(text)
            assert [i for p in parts for i in (aligner.b.encode(p) if p else [aligner.blank])] == b.encode(text), repr(text)


def run(spark, texts, **kw):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    out = crosstoken.align(df, A, B, files.PATTERN, **kw)
    return {r.doc_id: tuple(r[c] for c in ADDED) for r in out.collect()}


def test_alignment_equals_the_definition(spark, monkeypatch):
    texts = odd_texts()
    expected = dict(enumerate(by_definition(texts)))
    assert run(spark, texts) == expected
    # rare pairs by the join, down to none in the broadcast table; a small memo
    assert run(spark, texts, max_pairs=40) == expected
    assert run(spark, texts, max_pairs=0) == expected


def test_small_memo(monkeypatch):
    monkeypatch.setattr(crosstoken, "MEMO_PARTS", 3)
    with open(A, encoding="utf-8") as fa, open(B, "rb") as fb:
        aligner = crosstoken.Aligner(fa.read(), fb.read(), files.PATTERN)
    for text in odd_texts()[:50]:
        numbers = aligner.look_up([text])[0]
        assert len(numbers) == len(aligner.parts(text) if text else [])


def test_registered_query_equals_the_definition(spark):
    small = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    expected = dict(zip((r.doc_id for r in rows), by_definition([r.text for r in rows])))
    out = driver.queries()["op12_crosstoken"](spark, small)
    assert out.columns == ["doc_id", *ADDED]
    assert {r.doc_id: tuple(r[c] for c in ADDED) for r in out.collect()} == expected


def test_other_columns_and_empty_tables(spark):
    df = spark.createDataFrame(
        [(1, "some text", 5, "x"), (1, None, None, "y")], "doc_id long, body string, r int, codes string"
    )
    out = crosstoken.align(df, A, B, files.PATTERN, text_col="body", groups=True)
    assert out.columns[:3] == ["doc_id", "r", "codes"]
    shown = {r.codes: (r.r, r.groups) for r in out.collect()}
    assert shown["y"] == (None, "") and shown["x"][0] == 5 and "|" in shown["x"][1]
    assert crosstoken.align(df.limit(0), A, B, text_col="body").collect() == []
