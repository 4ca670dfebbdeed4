"""The load in SQL, exact money in both modes, and plans of the SQL formulation."""

from __future__ import annotations

import os

import pytest

from retail_support import SF0001, lines_df
from tillroll.functions import parse as P
from tillroll.functions.money import total, total_sql
from tillroll.operators import unsold
from tillroll.plans import sql as S
from tillroll.plans import text_sql
from tillroll.plans.inspect import plan_text
from tillroll.report import answers
from tillroll.sources import testdata as td
from tillroll.sources.ingest import load_text_tables
from tillroll.sources.schema import FILE_NAMES, SPECS
from tillroll.sources.text import parse

MONEY = ["$1,234.50", "4995", "", "-5", "(12.50)", "1e3", "1.2.3", ".", "N/A", None, " $7 ", "9" * 400, "  -3", "0", "-0"]
STAMPS = ["05/01/2013 10:00:00", "5/1/2013 1:2:3", "13/1/2013 1:2:3", "2/30/2013 1:1:1", "", None, "5/1/2013 1:2:60",
          "05/01/13 10:00:00", " 5/1/2013 1:2:3", "5/1/2013 1:2:3 pm"]
WHOLE = ["1", " 2 ", "two", "", None, "99999999999", "-4", "1.5"]


def test_functions_equal_the_columns(spark):
    text_sql.register_functions(spark, "fn_")
    for texts, call, column in [
        (MONEY, "fn_money(value)", lambda c: P.money(c)),
        (MONEY, "fn_signed_money(value)", lambda c: P.money(c, signed=True)),
        (STAMPS, "fn_stamp(value)", lambda c: P.timestamp(c)),
        (WHOLE, "fn_whole(value)", lambda c: P.integer(c)),
    ]:
        df = lines_df(spark, texts)
        rows = df.selectExpr(f"{call} AS x").collect()
        expected = df.select(column("value").alias("x")).collect()
        assert [repr(r.x) for r in rows] == [repr(r.x) for r in expected], call


@pytest.mark.parametrize("name", list(SPECS))
def test_parse_by_sql_equals_the_parser(spark, name):
    lines = getattr(td, f"{name}_lines")(spark, SF0001, **({"dirty": True} if name == "sales" else {}))
    good, expected = text_sql.parse_lines(spark, lines, name, "eq_"), parse(lines, name)
    assert good.schema.simpleString() == expected.good.schema.simpleString()
    key = lambda df: sorted(map(repr, df.collect()))
    assert key(good) == key(expected.good)
    assert key(text_sql.quarantined_lines(spark, lines, name, "eq_")) == key(expected.bad)
    plan = plan_text(good, "formatted")
    assert "Python" not in plan and "Exchange" not in plan_text(good.limit(0), "formatted")


def test_null_blank_and_short_lines(spark):
    lines = lines_df(spark, [None, "", "a|b", "t|c|p|05/01/2013 10:00:00||", "t|c|p|x|1|1", "t|c|p|05/01/2013 10:00:00|1|one"])
    got = text_sql.quarantined_lines(spark, lines, "sales", "odd_").collect()
    assert sorted(map(repr, got)) == sorted(map(repr, parse(lines, "sales").bad.collect()))
    statement = text_sql.parse_sql("sales", "odd_sales_lines", "odd_", mode="failfast")
    with pytest.raises(Exception, match="short line"):
        spark.sql(statement).collect()
    with pytest.raises(ValueError):
        text_sql.parse_sql("sales", "x", mode="other")


def test_questions_from_text_by_sql_alone(spark, scratch):
    from fixtures import CUSTOMERS, PRODUCTS, REFUND_ROWS, SALES_ROWS

    def text(v):
        return v.strftime("%m/%d/%Y %H:%M:%S") if hasattr(v, "strftime") else str(v)

    extended = ["|".join(["C1", "A", "B", "1", "2", "F", *["1154 Winters blvd", "x", "y", "z", "9"] * 3, *["e"] * 5])]
    rows = {"product": PRODUCTS, "customer": CUSTOMERS, "sales": SALES_ROWS, "refund": REFUND_ROWS}
    folder = os.path.join(scratch, "it's text")
    os.makedirs(folder)
    for name, file in FILE_NAMES.items():
        lines = extended if name == "customer_extended" else ["|".join(map(text, r)) for r in rows[name]]
        with open(os.path.join(folder, file), "w") as f:
            f.write("\n".join(lines) + "\n")
    text_sql.register_text_views(spark, folder, "tx_")
    key = lambda df: sorted(tuple(r) for r in df.collect())
    by_df = {k[0]: v for k, v in answers(load_text_tables(spark, folder), any_refund=True, fan_out=True).items()}
    by_sql = {
        "2": S.sales_distribution(spark, keep_unsold=False, prefix="tx_"),
        "3": S.unrefunded_total(spark, 2013, prefix="tx_"),
        "4": S.nth_best_customer(spark, 2013, 5, fan_out=True, prefix="tx_"),
        "5": S.unsold_products(spark, prefix="tx_"),
        "6": S.repeat_purchases(spark, prefix="tx_"),
        "7": S.customers_at_address(spark, "1154 Winters Blvd", prefix="tx_"),
    }
    for number, df in by_sql.items():
        assert key(df) == key(by_df[number]), number
        assert "Python" not in plan_text(df, "formatted")


# -------------------------------------------------------------------------------- money


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_totals_never_wrap(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        large = spark.range(1100).selectExpr("9e13D AS x", "id % 2 AS k")
        for df in (large.groupBy().agg(total("x").alias("t")), large.selectExpr(f"{total_sql('x')} AS t")):
            with pytest.raises(Exception, match="overflow"):
                df.collect()
        fits = spark.range(1000).selectExpr("9e13D AS x")
        for df in (fits.agg(total("x").alias("t")), fits.selectExpr(f"{total_sql('x')} AS t")):
            assert int(df.first().t) == 9 * 10**18
        S.register_views(
            spark, "wrap_", product=spark.createDataFrame([(0, "n", "t"), (1, "n", "t")], "product_id long, product_name string, product_type string"),
            sales=large.selectExpr("k AS product_id", "x AS total_amount"),
        )
        # each product's total fits, their sum in the decimal of 26 digits does too
        both = S.sales_distribution(spark, prefix="wrap_").first().total_sales
        assert both == 1100 * 9e13
        with pytest.raises(Exception, match="not a number"):
            spark.sql(f"SELECT {total_sql('x')} AS t FROM VALUES (double('NaN')) AS v(x)").collect()
        empty = spark.sql(f"SELECT {total_sql('x')} AS t FROM VALUES (1.0D) AS v(x) WHERE x > 2").first()
        assert empty.t is None
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


# -------------------------------------------------------------------------------- plans


def test_sql_ranking_aggregates_only_the_refunds_of_the_month(spark):
    S.register_views(spark, "semi_", sales=td.order_sales(spark, SF0001), refund=td.refunds(spark, SF0001),
                     customer=td.customers(spark, SF0001))
    plan = plan_text(S.nth_best_customer(spark, 1997, 5, prefix="semi_"), "simple")
    assert "LeftSemi" in plan


def test_no_hint_is_needed_to_broadcast_a_small_side(spark):
    """The broadcast hint of the question "products never sold": Spark's own size check
    broadcasts the distinct sold ids of an anti join, and beyond the threshold it sorts."""
    import inspect

    assert "broadcast" not in inspect.getsource(unsold).lower()
    df = lambda: unsold.unsold_products(
        td.products(spark, SF0001), td.line_sales(spark, SF0001, with_order=False)
    )
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "100m")
        assert "BroadcastHashJoin" in plan_text(df(), "simple")
        spark.conf.set(key, "-1")
        assert "SortMergeJoin" in plan_text(df(), "simple")
    finally:
        spark.conf.set(key, before)
