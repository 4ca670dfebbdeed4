"""Money totals: nothing is cut or passes silently, and both formulations agree."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillroll.functions import parse as P
from tillroll.functions.money import as_double, cents, sum_cents, total
from tillroll.operators import refunds
from tillroll.operators.distribution import sales_distribution
from tillroll.plans import sql as S

NOW = dt.datetime(2013, 5, 2)


def views(spark, amounts, back=()):
    sales = spark.createDataFrame(
        [(f"t{i}", "C", "P", NOW, a, 1) for i, a in enumerate(amounts)],
        "transaction_id string, customer_id string, product_id string, timestamp timestamp_ntz, "
        "total_amount double, total_quantity int",
    )
    refund = spark.createDataFrame(
        [(f"r{i}", "t0", "C", "P", NOW, a, 1) for i, a in enumerate(back)],
        "refund_id string, original_transaction_id string, customer_id string, product_id string, "
        "timestamp timestamp_ntz, refund_amount double, refund_quantity int",
    )
    product = spark.createDataFrame([("P", "n", "t", "v", 1.0)], "product_id string, product_name string, "
                                    "product_type string, product_version string, product_price double")
    customer = spark.createDataFrame([("C", "a", "b")], "customer_id string, customer_first_name string, "
                                     "customer_last_name string")
    S.register_views(spark, "exact_", sales=sales, refund=refund, product=product, customer=customer)
    return sales, refund, product


def totals(spark, amounts):
    sales, refund, product = views(spark, amounts)
    return (
        sales_distribution(sales, product).collect()[0].total_amount,
        S.sales_distribution(spark, prefix="exact_").collect()[0].total_sales,
        refunds.unrefunded_total(sales, refund, 2013).collect()[0][0],
        S.unrefunded_total(spark, 2013, prefix="exact_").collect()[0][0],
    )


@pytest.mark.parametrize("amounts, want", [
    ([0.285, 1.005], 1.29), ([0.1] * 10, 1.0), ([0.001] * 3, 0.003), ([5.0, None], 5.0),
    ([8.9e13, 0.01], 89000000000000.01), ([-0.005, 0.005], 0.0), ([None, None], None),
    ([1e-9, 2.5], 2.500000001),
])
def test_totals_are_exact_in_both_forms(spark, amounts, want):
    assert totals(spark, amounts) == (want,) * 4


@pytest.mark.parametrize("amount", [float("inf"), float("-inf"), float("nan"), 1e17, 1e300])
def test_amounts_out_of_range_fail(spark, amount):
    before = spark.conf.get("spark.sql.ansi.enabled")
    sales, refund, product = views(spark, [amount, 1.0], [amount])
    jobs = (
        sales_distribution(sales, product), S.sales_distribution(spark, prefix="exact_"),
        refunds.net_sales_per_customer(sales, refund, 2013, 5),
        S.nth_best_customer(spark, 2013, 5, 1, prefix="exact_"),
    )
    try:
        for ansi in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", ansi)
            for job in jobs:
                with pytest.raises(Exception, match="overflows"):
                    job.select("*").collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_net_of_sub_cent_refunds(spark):
    sales, refund, _ = views(spark, [10.0, 0.5], [0.005, 1.25])
    per = refunds.net_sales_per_customer(sales, refund, 2013, 5)
    assert per.select(as_double("net_cents")).collect()[0][0] == 9.245
    sql = S.nth_best_customer(spark, 2013, 5, 1, prefix="exact_").collect()[0]
    assert sql.net_total == 9.245
    fan = refunds.net_sales_per_customer(sales, refund, 2013, 5, fan_out=True)
    assert fan.select(as_double("net_cents")).collect()[0][0] == 19.245
    assert S.nth_best_customer(spark, 2013, 5, 1, fan_out=True, prefix="exact_").collect()[0].net_total == 19.245


def test_a_long_run_of_digits_fails_the_total(spark):
    df = spark.createDataFrame([("9" * 400,)], "v string").select(P.money("v").alias("x"))
    assert df.collect()[0].x == float("inf")
    with pytest.raises(Exception, match="overflows"):
        df.agg(total("x")).collect()


def test_sums_beyond_64_bits(spark):
    df = spark.range(3000).select(F.lit(8.9e13).alias("x"))
    with pytest.raises(Exception, match="overflows"):
        df.agg(total("x")).collect()
    assert df.agg(as_double(sum_cents(cents("x")))).collect()[0][0] == 2.67e17
