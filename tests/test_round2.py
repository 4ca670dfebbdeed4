"""Writes, streams, lines and the report: what must not get lost."""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F

from retail_support import lines_df
from tillroll import report
from tillroll.functions import parse as P
from tillroll.functions.clean import US_STATES
from tillroll.operators import refunds
from tillroll.operators.quality import dq_report
from tillroll.plans.inspect import plan_text
from tillroll.sources import ingest as I
from tillroll.sources import testdata as td
from tillroll.sources.text import load_table, parse
from tillroll.streaming.ingest import start_ingest, stream_table

HEAD = "t{0}|c1|p1|05/0{1}/2013 10:00:00"


def write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("".join(f"{line}\n" for line in lines))


def test_second_60_and_impossible_dates_are_bad(spark):
    texts = ["5/1/2013 1:2:60", "5/1/2013 1:60:0", "5/1/2013 24:0:0", "2/30/2013 1:1:1", "2013-05-01 01:01:01",
             "5/1/2013 1:2:59", "12/31/2013 23:59:59", "2/29/2012 0:0:0"]
    got = lines_df(spark, texts).select(P.timestamp("value").cast("string").alias("t")).collect()
    assert [r.t for r in got] == [None] * 5 + ["2013-05-01 01:02:59", "2013-12-31 23:59:59", "2012-02-29 00:00:00"]


def test_parse_is_evaluated_once_and_only_for_fields_read(spark):
    df = lines_df(spark, ["x"])
    bad = plan_text(parse(df, "sales").bad, "formatted")
    assert bad.count("timestamp_ntz") <= 3
    good = plan_text(parse(df, "sales").good.select("product_id"), "formatted")
    assert "[^0-9.]" not in good  # the money cleaner is pruned
    assert "[^0-9.]" in plan_text(parse(df, "sales").good, "formatted")


def test_refund_without_tail_counts_as_refund(spark, scratch):
    sales = [HEAD.format(i, 1) + f"|{i}0|1" for i in (1, 2, 3)]
    back = ["r1|t1|c1|p1|05/02/2013 10:00:00", "r2|t2|c1|p1|05/02/2013 10:00:00||"]
    write(f"{scratch}/s", sales)
    write(f"{scratch}/r", back)
    sale, refund = load_table(spark, f"{scratch}/s", "sales"), load_table(spark, f"{scratch}/r", "refund")
    assert [(r.refund_amount, r.refund_quantity) for r in refund.collect()] == [(0.0, None)] * 2
    assert refunds.unrefunded_total(sale, refund, 2013).collect()[0][0] == 30.0
    report_ = {(r.field, r.check_name): r.n for r in dq_report(lines_df(spark, back), "refund").collect()}
    assert report_["*", "missing_tail"] == 1 and report_["*", "short_line"] == 0
    assert report_["refund_amount", "blank"] == 1
    assert parse(lines_df(spark, ["r1|t1|c1|p1"]), "refund").bad.count() == 1


def test_bucketed_write_makes_a_file_per_bucket(spark, scratch):
    for i in range(12):  # many input splits
        write(f"{scratch}/in/Sales.txt/{i}", [HEAD.format(f"{i}-{j}", 1) + "|5|1" for j in range(40)] + ["|||bad||"] * 30)
    I.ingest(spark, f"{scratch}/in", f"{scratch}/out", tables=("sales",), buckets=4, table_prefix="few_")
    good = glob.glob(f"{scratch}/out/sales/_status=ok/*.parquet")
    bad = glob.glob(f"{scratch}/out/sales/_status=bad/*.parquet")
    assert len(good) == 4 and len(bad) <= 4
    df = I.load_bucketed(spark, "sales", "few_")
    assert df.count() == 480 and I.load_quarantine(spark, f"{scratch}/out", "sales").count() == 360
    assert "Exchange" not in plan_text(df.groupBy("transaction_id").count(), "simple")
    spark.sql("DROP TABLE few_sales")
    with pytest.raises(ValueError):
        I.ingest(spark, f"{scratch}/in", f"{scratch}/out2", tables=("sales",), buckets=4, by_month=True)


def test_month_write_spreads_lines_without_month(spark, scratch):
    for i in range(4):
        write(f"{scratch}/in/Sales.txt/{i}", [HEAD.format(j, 1 + j % 9) + "|5|1" for j in range(100)] + ["bad"] * 3000)
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size, None)
    spark.conf.set(size, "4k")
    try:
        I.ingest(spark, f"{scratch}/in", f"{scratch}/out", tables=("sales",), by_month=True)
    finally:
        spark.conf.set(size, before) if before else spark.conf.unset(size)
    assert len(glob.glob(f"{scratch}/out/sales/_status=bad/*/*.parquet")) > 1
    assert I.load(spark, f"{scratch}/out", "sales").count() == 400
    assert I.load_quarantine(spark, f"{scratch}/out", "sales").count() == 12000


def test_stream_refuses_a_batch_folder_and_has_the_street_key(spark, scratch):
    fields = ["1", "A", "B", "1", "2", "Male", *["1 Ab st", "c", "CA", "usa", "9"] * 3, *["a@b.com"] * 5]
    write(f"{scratch}/in/Customer_Extended.txt", ["|".join(fields)])
    I.ingest(spark, f"{scratch}/in", f"{scratch}/batch", tables=("customer_extended",))
    rows = stream_table(spark, f"{scratch}/in", "customer_extended")
    with pytest.raises(ValueError, match="no stream wrote"):
        start_ingest(spark, rows, f"{scratch}/batch/customer_extended", "customer_extended")
    for _ in range(2):  # a restart of the same stream is fine
        start_ingest(spark, rows, f"{scratch}/own/customer_extended", "customer_extended").awaitTermination()
    batch, stream = (I.load(spark, f"{scratch}/{x}", "customer_extended") for x in ("batch", "own"))
    assert batch.columns == stream.columns and batch.collect() == stream.collect()


def test_report_writes_whole_answers_and_says_when_it_cuts(spark, scratch, capsys):
    write(f"{scratch}/Sales.txt", [f"t{i}|c{i % 3}|p{i}|05/01/2013 10:00:00|{i}|1" for i in range(40)] + ["bad"])
    write(f"{scratch}/Refund.txt", ["r1|t1|c1|p1|05/02/2013 10:00:00"])
    write(f"{scratch}/Product.txt", [f"p{i}|n{i}|t|1|5" for i in range(45)])
    write(f"{scratch}/Customer.txt", [f"c{i}|A|B|1" for i in range(3)])
    write(f"{scratch}/Customer_Extended.txt", ["|".join(["1"] * 26)])
    with pytest.raises(Exception, match="short line"):
        report.main([scratch])
    report.main([scratch, "--quarantine", "--out", f"{scratch}/answers", "--rows", "3"])
    shown = capsys.readouterr().out
    assert "cut after 3 rows" in shown
    assert spark.read.parquet(f"{scratch}/answers/2").count() == 40
    assert spark.read.parquet(f"{scratch}/answers/5").count() == 5
    report.main([scratch, "--quarantine", "--out", f"{scratch}/answers"])
    assert "+--" not in capsys.readouterr().out


def test_rendered_ids_are_not_cut_and_nulls_shift_nothing(spark):
    df = spark.createDataFrame([("123456789",), ("12",)], "k string")
    assert [r[0] for r in df.select(td._padded(F.col("k"), 7)).collect()] == ["123456789", "0000012"]
    null = F.lit(None).cast("string")
    assert df.limit(1).select(td._pipe(null, F.lit("a"), null, F.lit(1))).collect()[0][0] == "|a||1"


def test_state_codes_are_the_fifty_and_dc():
    codes = (
        "AL AK AZ AR CA CO CT DE DC FL GA HI ID IL IN IA KS KY LA ME MD MA MI MN MS MO MT NE NV NH NJ NM NY "
        "NC ND OH OK OR PA RI SC SD TN TX UT VT VA WA WV WI WY"
    ).split()
    assert sorted(code for _, code in US_STATES) == sorted(codes)
    assert dict(US_STATES)["Missouri"] == "MO" and dict(US_STATES)["Mississippi"] == "MS"
