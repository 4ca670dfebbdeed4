"""Text files on disk: batch ingest to parquet, and the same parser over a file stream."""

from __future__ import annotations

import os

from tillroll.sources.ingest import ingest, load, load_quarantine, load_text_tables
from tillroll.sources.schema import FILE_NAMES
from tillroll.streaming import start_ingest, stream_table

SALES = [
    "T1|C1|P1|05/01/2013 10:00:00|$1,000|1",
    "T2|C2|P2|05/02/2013 11:00:00|700|1",
    "T3|C2|P2|not a date|700|1",
]
REFUND = ["R1|T1|C1|P1|05/10/2013 10:00:00|$100|1", "R2|T1|C1|P1|05/11/2013 10:00:00||"]
PRODUCT = ["P1|Desktop |P106|v1|$949", "P2|Laptop |P105|v1|677"]
CUSTOMER = ["C1|ANN|LEE|1", "C2||RAY|2"]
EXT = ["|".join(["C1", "ANN", "LEE", "1", "2", "F"] + ["a"] * 15 + ["e"] * 5)]


def _write(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        fh.write("\n".join(lines) + "\n")


def _text_dir(scratch):
    d = os.path.join(scratch, "text")
    for table, lines in [("sales", SALES), ("refund", REFUND), ("product", PRODUCT),
                         ("customer", CUSTOMER), ("customer_extended", EXT)]:
        _write(d, FILE_NAMES[table], lines)
    return d


def test_ingest_round_trip(spark, scratch):
    text = _text_dir(scratch)
    out = os.path.join(scratch, "parquet")
    written = ingest(spark, text, out)
    assert set(written) == set(FILE_NAMES)
    sales = load(spark, out, "sales")
    assert sorted(r.transaction_id for r in sales.collect()) == ["T1", "T2"]
    bad = load_quarantine(spark, out, "sales").collect()
    assert [(b.value.split("|")[0], b.reason) for b in bad] == [("T3", "bad timestamp")]
    refund = {r.refund_id: r for r in load(spark, out, "refund").collect()}
    assert refund["R2"].refund_amount == 0.0 and refund["R2"].refund_quantity is None
    assert load(spark, out, "customer_extended").count() == 1


def test_text_tables_failfast(spark, scratch):
    import pytest

    tables = load_text_tables(spark, _text_dir(scratch))
    assert tables["product"].count() == 2
    with pytest.raises(Exception, match="bad timestamp"):
        tables["sales"].collect()


def test_stream_ingest_available_now(spark, scratch):
    src = os.path.join(scratch, "incoming")
    _write(src, "part-1.txt", SALES[:2])
    _write(src, "part-2.txt", SALES[2:])
    out = os.path.join(scratch, "stream-out")
    parsed = stream_table(spark, src, "sales")
    q = start_ingest(spark, parsed, out, "sales")
    q.awaitTermination(120)
    df = spark.read.parquet(out)
    assert sorted(r.transaction_id for r in df.filter("_status = 'ok'").collect()) == ["T1", "T2"]
    assert df.filter("_status = 'bad'").count() == 1
    # a second run with no new files adds nothing (checkpointed progress)
    q2 = start_ingest(spark, stream_table(spark, src, "sales"), out, "sales")
    q2.awaitTermination(120)
    assert spark.read.parquet(out).count() == 3


def test_report_answers_from_text(spark, scratch):
    from tillroll.report import answers

    text = _text_dir(scratch)
    out = os.path.join(scratch, "parquet")
    ingest(spark, text, out)
    tables = {name: load(spark, out, name) for name in FILE_NAMES}
    res = answers(tables, street="a")
    got = {k.split(".")[0]: v.collect() for k, v in res.items()}
    assert [tuple(r) for r in got["2"]] == [("Desktop ", "P106", 1000.0), ("Laptop ", "P105", 700.0)]
    assert got["3"][0][0] == 700.0
    assert [r.customer_id for r in got["4"]] == ["C2"]  # C1 nets 900, C2 700
    assert got["5"] == []
    assert got["6"][0].n_groups == 0
    assert [r.id for r in got["7"]] == ["C1"]


def test_bucketed_ingest_joins_without_shuffle(spark, scratch):
    from tillroll.operators import refunds
    from tillroll.plans.inspect import plan_text
    from tillroll.sources.ingest import load_bucketed

    text = _text_dir(scratch)
    out = os.path.join(scratch, "bucketed")
    ingest(spark, text, out, tables=("sales", "refund"), buckets=4, table_prefix="bk_")
    sales = load_bucketed(spark, "sales", "bk_")
    refund = load_bucketed(spark, "refund", "bk_")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # force the shuffle-join plan
    try:
        for df in (
            refunds.net_sales(sales, refund, 2013, 5),
            refunds.unrefunded_sales(sales, refund, 2013),
        ):
            text_plan = plan_text(df, "simple")
            assert "SortMergeJoin" in text_plan
            assert "Exchange" not in text_plan, text_plan
        per = refunds.net_sales_per_customer(sales, refund, 2013, 5).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted((r.customer_id, r.net_cents) for r in per) == [("C1", 90000), ("C2", 70000)]


def test_report_cli_prints_all_answers(spark, scratch, capsys):
    from tillroll.report import main

    text = _text_dir(scratch)
    _write(text, FILE_NAMES["sales"], SALES[:2])  # only well-formed lines: fail-fast passes
    main([text, "--street", "a", "--rows", "5"])
    out = capsys.readouterr().out
    for title in ("2. sales by product", "3. unrefunded sales of 2013", "4. customer ranked 2",
                  "5. products never sold", "6. same product bought", "7. customers at a"):
        assert title in out


def test_report_cli_fails_fast_on_bad_line(spark, scratch):
    import pytest

    from tillroll.report import main

    text = _text_dir(scratch)  # its sales file has a line with a bad timestamp
    with pytest.raises(Exception, match="bad timestamp"):
        main([text])


def test_stream_picks_up_only_new_files(spark, scratch):
    src = os.path.join(scratch, "arriving")
    out = os.path.join(scratch, "arriving-out")
    _write(src, "a.txt", SALES[:1])
    start_ingest(spark, stream_table(spark, src, "sales"), out, "sales").awaitTermination(120)
    assert spark.read.parquet(out).count() == 1
    _write(src, "b.txt", SALES[1:])
    start_ingest(spark, stream_table(spark, src, "sales"), out, "sales").awaitTermination(120)
    df = spark.read.parquet(out)
    assert sorted((r.transaction_id, r._status) for r in df.select("transaction_id", "_status").collect()) == [
        ("T1", "ok"), ("T2", "ok"), ("T3", "bad")
    ]


def test_report_reference_variants(spark, scratch):
    from tillroll.report import answers

    text = _text_dir(scratch)
    out = os.path.join(scratch, "parquet-variants")
    ingest(spark, text, out)
    tables = {name: load(spark, out, name) for name in FILE_NAMES}
    q4 = {
        (fan, anyr): [(r.customer_id, r.net_total) for r in
                      answers(tables, rank=1, fan_out=fan, any_refund=anyr)["4. customer ranked 1 in 2013-05"].collect()]
        for fan in (False, True) for anyr in (False, True)
    }
    # T1 = $1,000 with refunds $100 and $0 (two rows): pre-aggregated 900, fan-out 1900
    assert q4[(False, False)] == [("C1", 900.0)]
    assert q4[(True, False)] == [("C1", 1900.0)]
    assert q4[(True, True)] == [("C1", 1900.0)]


def test_month_partitioned_ingest_prunes_folders(spark, scratch):
    from tillroll.operators import refunds, unsold
    from tillroll.plans.inspect import plan_text

    text = _text_dir(scratch)
    _write(text, FILE_NAMES["sales"], SALES + ["T4|C1|P2|07/04/2014 09:00:00|$50|1"])
    out = os.path.join(scratch, "by-month")
    ingest(spark, text, out, by_month=True)
    assert sorted(d for d in os.listdir(os.path.join(out, "sales", "_status=ok"))
                  if d.startswith("_month=")) == ["_month=201305", "_month=201407"]
    sales, refund = load(spark, out, "sales"), load(spark, out, "refund")
    assert "_month" in sales.columns
    # a line without a valid timestamp has no month: it sits in the default partition
    bad = load_quarantine(spark, out, "sales").collect()
    assert [(b.value.split("|")[0], b.reason) for b in bad] == [("T3", "bad timestamp")]
    per = refunds.net_sales_per_customer(sales, refund, 2013, 5)
    before = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        text_plan = plan_text(per, "simple")
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", before)
    import re

    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", text_plan)
    assert any(re.search(r"_month#\d+ >= 201305", f) and re.search(r"_month#\d+ <= 201305", f)
               for f in filters), filters  # sales: one month folder
    assert any(re.search(r"_month#\d+ >= 201301", f) for f in filters), filters  # refunds
    assert sorted((r.customer_id, r.net_cents) for r in per.collect()) == [("C1", 90000), ("C2", 70000)]
    assert refunds.unrefunded_total(sales, refund, 2014).collect()[0][0] == 50.0
    import datetime as dt
    got = unsold.unsold_products(load(spark, out, "product"), sales, dt.date(2014, 7, 1), dt.date(2014, 8, 1))
    assert [r.product_id for r in got.collect()] == ["P1"]


def test_ingest_cli(spark, scratch, capsys):
    from tillroll.sources.ingest import main

    text = _text_dir(scratch)
    out = os.path.join(scratch, "cli-out")
    main([text, out, "--by-month"])
    printed = capsys.readouterr().out
    assert all(f"{name}: " in printed for name in FILE_NAMES)
    assert load(spark, out, "sales").count() == 2


def test_stream_by_month_reads_back_with_load(spark, scratch):
    src = os.path.join(scratch, "stream-src")
    _write(src, "a.txt", SALES)
    warehouse = os.path.join(scratch, "stream-wh")
    q = start_ingest(spark, stream_table(spark, src, "sales"), os.path.join(warehouse, "sales"),
                     "sales", by_month=True)
    q.awaitTermination(120)
    sales = load(spark, warehouse, "sales")
    assert "_month" in sales.columns
    assert sorted(r.transaction_id for r in sales.collect()) == ["T1", "T2"]


def test_failfast_ingest_raises_instead_of_quarantining(spark, scratch):
    import pytest

    text = _text_dir(scratch)  # its sales file has a line with a bad timestamp
    with pytest.raises(Exception, match="bad timestamp"):
        ingest(spark, text, os.path.join(scratch, "ff"), tables=("sales",), mode="failfast")
    ingest(spark, text, os.path.join(scratch, "ff2"), tables=("product",), mode="failfast")
    assert load(spark, os.path.join(scratch, "ff2"), "product").count() == 2


def test_signed_money_option(spark, scratch):
    text = _text_dir(scratch)
    _write(text, FILE_NAMES["product"], ["P1|Desktop |P106|v1|-$949", "P2|Laptop |P105|v1|(677)"])
    plain = {r.product_id: r.product_price for r in load_text_tables(spark, text)["product"].collect()}
    signed = {r.product_id: r.product_price
              for r in load_text_tables(spark, text, signed_money=True)["product"].collect()}
    assert plain == {"P1": 949.0, "P2": 677.0}
    assert signed == {"P1": -949.0, "P2": -677.0}
    out = os.path.join(scratch, "signed")
    ingest(spark, text, out, tables=("product",), signed_money=True)
    assert sorted(r.product_price for r in load(spark, out, "product").collect()) == [-949.0, -677.0]


def test_report_cli_with_bucketed_tables(spark, scratch, capsys):
    from tillroll.report import main

    text = _text_dir(scratch)
    out = os.path.join(scratch, "bucketed-cli")
    ingest(spark, text, out, buckets=4, table_prefix="cli_")
    main([text, "--ingested", out, "--bucketed-prefix", "cli_", "--street", "a", "--rows", "5"])
    printed = capsys.readouterr().out
    assert "3. unrefunded sales of 2013" in printed and "700.0" in printed


def test_address_search_pushes_down_on_ingested_table(spark, scratch):
    from tillroll.operators.address import customers_at_address
    from tillroll.plans.inspect import pushed_filters

    text = _text_dir(scratch)
    out = os.path.join(scratch, "addr")
    ingest(spark, text, out, tables=("customer_extended",))
    ce = load(spark, out, "customer_extended")
    hit = customers_at_address(ce, "A")  # the fixture's street is "a"
    assert [r.id for r in hit.collect()] == ["C1"]
    assert any("EqualTo(_current_street,A)" in f for f in pushed_filters(hit))
    assert customers_at_address(ce, "b").count() == 0
