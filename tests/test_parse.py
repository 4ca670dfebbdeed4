"""Field parsers and the line parser (money, timestamps, short lines, structs)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from retail_support import lines_df
from tillroll.functions import parse as P
from tillroll.sources.schema import CUSTOMER_EXTENDED, REFUND, SALES
from tillroll.sources.text import flatten_struct, parse

MONEY_CASES = [
    ("$1,449", 1449.0),
    ("4995", 4995.0),
    ("", 0.0),
    (None, 0.0),
    ("N/A", 0.0),
    (".", 0.0),
    ("1.2.3", 0.0),
    ("-5", 5.0),
    ("(12.50)", 12.5),
    ("1e3", 13.0),
    ("5.", 5.0),
    (".5", 0.5),
    ("$1,234,567.89", 1234567.89),
]


def test_money_matches_reference_rules(spark):
    df = spark.createDataFrame([(s,) for s, _ in MONEY_CASES], "s string")
    got = [r[0] for r in df.select(P.money("s")).collect()]
    assert got == [v for _, v in MONEY_CASES]


def test_money_signed_option(spark):
    df = spark.createDataFrame([("-5",), ("(12.50)",), ("$3",), ("",)], "s string")
    got = [r[0] for r in df.select(P.money("s", signed=True)).collect()]
    assert got == [-5.0, -12.5, 3.0, 0.0]


@pytest.mark.parametrize(
    "text,expected",
    [
        ("05/01/2013 10:11:12", dt.datetime(2013, 5, 1, 10, 11, 12)),
        ("5/1/2013 1:2:3", dt.datetime(2013, 5, 1, 1, 2, 3)),
        ("12/31/1999 23:59:59", dt.datetime(1999, 12, 31, 23, 59, 59)),
        ("", None),
        ("abc", None),
        ("13/45/2013 25:61:61", None),
        ("02/30/2013 00:00:00", None),
        ("05/01/13 01:02:03", None),
        ("05/01/2013 10:11:12 junk", None),
        (None, None),
    ],
)
def test_timestamp(spark, text, expected):
    df = spark.createDataFrame([(text,)], "s string")
    row = df.select(P.timestamp("s").alias("t")).collect()[0]
    assert row.t == expected
    assert dict(df.select(P.timestamp("s").alias("t")).dtypes)["t"] == "timestamp_ntz"


def test_timestamp_does_not_depend_on_session_zone(spark):
    df = spark.createDataFrame([("03/10/2013 02:30:00",)], "s string")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = df.select(P.timestamp("s").cast("string")).collect()[0][0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == "2013-03-10 02:30:00"


def test_integer_and_bad_integer(spark):
    df = spark.createDataFrame([("7",), ("",), ("x",), (None,)], "s string")
    rows = df.select(P.integer("s"), P.is_bad_integer("s")).collect()
    assert [tuple(r) for r in rows] == [(7, False), (None, False), (None, True), (None, None)]


def test_trailing_empty_fields_are_kept(spark):
    # refund with empty amount and quantity at the end of the line
    p = parse(lines_df(spark, ["r1|t1|c1|p1|05/01/2013 10:00:00||"]), REFUND)
    row = p.good.collect()[0]
    assert row.refund_amount == 0.0 and row.refund_quantity is None
    assert p.bad.count() == 0


def test_quarantine_reasons(spark):
    lines = [
        "t1|c1|p1|05/01/2013 10:00:00|$1,000|2",
        "t2|c1|p1|05/01/2013 10:00:00",
        "t3|c1|p1|13/45/2013 25:61:61|5|1",
        "t4|c1|p1|05/01/2013 10:00:00|5|two",
        "t5|c1|p1||5|1",
        "t6|c1|p1|05/01/2013 10:00:00|5|1|extra",
    ]
    p = parse(lines_df(spark, lines), SALES)
    good = {r.transaction_id: r for r in p.good.collect()}
    assert set(good) == {"t1", "t6"}
    assert good["t1"].total_amount == 1000.0 and good["t1"].total_quantity == 2
    bad = {r.value.split("|")[0]: r.reason for r in p.bad.collect()}
    assert bad == {
        "t2": "short line",
        "t3": "bad timestamp",
        "t4": "bad integer",
        "t5": "bad timestamp",
    }


def test_failfast_raises_on_bad_line(spark):
    p = parse(lines_df(spark, ["t3|c1|p1|nope|5|1"]), SALES, mode="failfast")
    with pytest.raises(Exception, match="bad timestamp"):
        p.good.collect()


def test_failfast_passes_good_lines(spark):
    p = parse(lines_df(spark, ["t1|c1|p1|05/01/2013 10:00:00|5|1"]), SALES, mode="failfast")
    assert p.good.count() == 1 and p.bad.count() == 0


def test_names_keep_trailing_blanks(spark):
    p = parse(lines_df(spark, ["P1|Desktop |P106|v1|$949"]), "product")
    assert p.good.collect()[0].product_name == "Desktop "


def test_customer_extended_nested_schema(spark):
    fields = ["900001", "JANE", "ROE", "1", "2", "Female"]
    fields += ["1154 WINTERS Blvd", "SF", "CA", "USA", "94100"]
    fields += ["2251 HART Blvd", "PA", "Delaware", "USA", "19901"]
    fields += ["2694 HURST Blvd", "NY", "NY", "USA", "10001"]
    fields += ["a@hotmail.com", "b@gmail.com", "c@twitter.com", "@facebook.com", "d@linkedin.com"]
    p = parse(lines_df(spark, ["|".join(fields)]), CUSTOMER_EXTENDED)
    assert p.good.schema.simpleString() == CUSTOMER_EXTENDED.schema().simpleString()
    row = p.good.collect()[0]
    assert row.current_address.street_address == "1154 WINTERS Blvd"
    assert row.permanent_address.state == "Delaware"
    flat = flatten_struct(p.good, "office_address")
    assert "office_zip" in flat.columns and "office_address" not in flat.columns


def test_parse_never_uses_python(spark):
    from tillroll.plans.inspect import uses_python

    p = parse(lines_df(spark, ["t1|c1|p1|05/01/2013 10:00:00|5|1"]), SALES)
    assert not uses_python(p.good)
    assert not uses_python(p.bad)


def test_parse_evaluates_the_line_once(spark):
    """The reason must not be re-derived inside a pushed-down predicate."""
    from tillroll.plans.inspect import plan_text

    lines = spark.range(10).select(
        F.concat_ws("|", F.col("id"), F.lit("c"), F.lit("p"), F.lit("05/01/2013 10:00:00"),
                    F.format_number(F.col("id") * 1.5, 2), F.lit("1")).alias("value")
    )
    text = plan_text(parse(lines, SALES).good, "simple")
    assert text.count("format_number") == 1


def test_empty_trailing_fields_count(spark):
    from tillroll.sources.schema import CUSTOMER

    p = parse(lines_df(spark, ["a|b||", "a|b|"]), CUSTOMER)
    good = [tuple(r) for r in p.good.collect()]
    assert good == [("a", "b", "", "")]
    assert [r.reason for r in p.bad.collect()] == ["short line"]


def test_null_and_blank_lines_are_short(spark):
    from tillroll.operators.quality import dq_report

    df = spark.createDataFrame([(None,), ("",), ("t1|c1|p1|05/01/2013 10:00:00|5|1",)], "value string")
    p = parse(df, SALES)
    assert [r.transaction_id for r in p.good.collect()] == ["t1"]
    assert sorted(r.reason for r in p.bad.collect()) == ["short line", "short line"]
    rep = {(r.field, r.check_name): r.n for r in dq_report(df, SALES).collect()}
    assert rep[("*", "short_line")] == 2


def test_load_table_reads_one_file(spark, scratch):
    import os

    from tillroll.sources.text import load_table

    path = os.path.join(scratch, "Product.txt")
    with open(path, "w") as fh:
        fh.write("P1|Desktop |P106|v1|$949\nP2|Laptop |P105|v1|677\n")
    rows = sorted(tuple(r) for r in load_table(spark, path, "product").collect())
    assert rows == [("P1", "Desktop ", "P106", "v1", 949.0), ("P2", "Laptop ", "P105", "v1", 677.0)]
    flat = flatten_struct(
        spark.createDataFrame([(1, ("a", "b"))], "id int, home struct<street:string,city:string>"),
        "home", prefix="h",
    )
    assert flat.columns == ["id", "h_street", "h_city"]
