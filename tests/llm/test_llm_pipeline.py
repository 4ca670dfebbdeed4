"""The pipeline, stage by stage, and the registered queries."""

from __future__ import annotations

import hashlib
import random
import subprocess
import sys

import duckdb
import public_tokenizers
import pytest
import tiktoken

import __spark_entry__ as driver
import corpus_pipeline as pipeline
from llm_brute import hits, linked, repeats  # noqa: E402

from tillroll.llm import bpe
from tillroll.llm import entry as llm_entry

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rng = random.Random(6)
    words = {"en": ["the", "and", "tion", "with", "sher", "ing", "house"], "de": ["der", "ung", "schö", "und", "über", "ein"]}
    some = lambda lang, n: " ".join(rng.choice(words[lang]) + rng.choice(["", "s", "er", "a", "on"]) for _ in range(n))
    items = [(i, some("en", 14)) for i in range(4)]
    passage = some("de", 40)
    rows = []
    for i in range(60):
        lang = "en" if i % 3 else "de"
        rows.append([i, some(lang, rng.randint(5, 90)), lang])
    rows[7][1] = rows[4][1]  # an exact copy
    rows[8][1] = rows[5][1] + " end"
    rows[10][1] += "\n" + items[2][1]
    rows[12][1] += " " + passage
    rows[15][1] = passage + " " + rows[15][1]
    rows[20][1], rows[21][1], rows[22][1] = None, "", "123 -- 456"
    return [(i, t, lang, f"src{i % 2}", len(t or "")) for i, t, lang in rows], items


def test_stages_equal_brute_force(spark, scratch):
    rows, items = corpus()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    got = {r.doc_id: r for r in pipeline.run(spark, scratch).collect()}
    # brute force; every text with a letter is in a known language
    docs = [(i, t) for i, t, *_ in rows if t and any(c.isalpha() for c in t)]
    component = linked(docs)
    docs = [(i, t) for i, t in docs if component[i][1] == i]
    rest = repeats([t.encode() for _, t in docs], 100)
    docs = [(i, r[3].decode()) for (i, _), r in zip(docs, rest) if r[3].decode().strip()]
    found = hits(docs, items)
    docs = {i: t for i, t in docs if not found[i][1]}
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert {i: list(r.ids) for i, r in got.items()} == {i: library.encode_ordinary(t) for i, t in docs.items()}
    assert {i: r.n_chars for i, r in got.items()} == {i: len(t) for i, t in docs.items()}
    assert {7, 8, 10, 20, 21, 22}.isdisjoint(got) and {4, 5, 12, 15} <= set(got)
    assert sum(map(len, docs.values())) < sum(len(t or "") for _, t, *_ in rows)


def test_stages_take_empty_tables_and_further_columns(spark, scratch):
    spark.createDataFrame([(1, "a b c")], "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    extra = ["score", "ids", "n_hit", "removed", "lang_pred", "component", "label", "_row", "first", "kept"]
    rows = [(None, None, None, None, None), (1, "hello there you all now", "en", "s", 23),
            (1, "hello there you all now", "en", "s", 23), (2, "a b c", "en", None, 5), (3, "9", None, "s", 1)]
    full = spark.createDataFrame(rows, SCHEMA).selectExpr("*", *(f"'k' AS {c}" for c in extra))
    for number, (name, stage) in enumerate(pipeline.STAGES):
        assert stage(spark, full.limit(0), scratch).collect() == [], name
        out = stage(spark, full, scratch)
        out.collect()
        if number + 1 < len(pipeline.STAGES):
            assert out.columns == full.columns, name
    assert pipeline.near_duplicates(spark, full, scratch).count() == 4  # one of the equal rows goes
    assert sorted(r.doc_id for r in pipeline.language(spark, full, scratch).collect()) == [1, 1, 2]
    assert 2 not in [r.doc_id for r in pipeline.decontaminated(spark, full, scratch).collect()]


@pytest.mark.parametrize("name", [n for n in driver.oracle_sql() if n in llm_entry.QUERIES])
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    df = driver.queries()[name](spark, SMALL)
    cur = con.execute(driver.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(repr, map(tuple, df.select(*columns).collect()))) == sorted(map(repr, cur.fetchall()))


def test_document_queries_equal_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    rows.sort()
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    sha = lambda x: hashlib.sha256(x).hexdigest()
    got = {r.doc_id: tuple(r)[1:] for r in llm_entry.op5_suffix(spark, SMALL).collect()}
    want = repeats([(t or "").encode() for _, t in rows], 100)
    assert got == {i: (n, cut, runs, sha(rest)) for (i, _), (n, cut, runs, rest) in zip(rows, want)}
    got = {r.doc_id: tuple(r)[1:] for r in llm_entry.op7_jaccard(spark, SMALL).collect()}
    assert got == linked(rows)
    got = {r.doc_id: tuple(r)[1:] for r in llm_entry.op9_decontaminate(spark, SMALL).collect()}
    assert got == {
        i: (n, hit, len(ids), sha(",".join(sorted(map(str, ids))).encode()), hit > 0)
        for i, (n, hit, ids) in hits(rows, items).items()
    }
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: tuple(r)[1:] for r in llm_entry.op2_bpe(spark, SMALL).collect()}
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        packed = b"".join(x.to_bytes(4, "little") for x in ids)
        assert got[i] == (len(ids), sha(packed), sha((t or "").encode()))


def test_registered_names():
    names = list(driver.queries())
    assert [n.split("_")[0] for n in names if n.startswith("op")] == [f"op{i}" for i in range(1, 14)]
    assert "pipeline" in names and set(driver.oracle_sql()) <= set(names)


def test_nothing_else_imports_the_package():
    code = (
        "import sys, importlib, pkgutil, tillroll\n"
        "for m in pkgutil.walk_packages(tillroll.__path__, 'tillroll.'):\n"
        "    if not m.name.startswith('tillroll.llm'): importlib.import_module(m.name)\n"
        "assert not [m for m in sys.modules if m.startswith('tillroll.llm.')]\n"
    )
    assert subprocess.run([sys.executable, "-c", code], cwd=driver._HERE).returncode == 0
