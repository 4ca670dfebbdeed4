"""Hot keys: one customer, one product and one refunded transaction each hold a third of
the rows. Results are checked against a brute-force pandas computation, and the plans
must combine map-side before every shuffle on those keys."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillroll.operators import distribution, ranking, refunds, repeats
from tillroll.plans.inspect import plan_text

N = 90_000


@pytest.fixture(scope="module")
def skewed(spark):
    ids = spark.range(N)
    hot = (F.col("id") % 3) == 0
    sales = ids.select(
        F.concat(F.lit("T"), F.col("id").cast("string")).alias("transaction_id"),
        F.when(hot, F.lit("HOT")).otherwise(F.concat(F.lit("C"), (F.col("id") % 500).cast("string"))).alias("customer_id"),
        F.when(hot, F.lit("PHOT")).otherwise(F.concat(F.lit("P"), (F.col("id") % 50).cast("string"))).alias("product_id"),
        F.make_timestamp_ntz(F.lit(2013), F.lit(5), (F.col("id") % 28 + 1).cast("int"),
                             (F.col("id") % 24).cast("int"), F.lit(0), F.lit(0)).alias("timestamp"),
        ((F.col("id") % 100) + F.lit(0.25)).alias("total_amount"),
        F.lit(1).alias("total_quantity"),
    )
    # every third refund row points at transaction T1 (a hot transaction)
    refund = spark.range(N // 3).select(
        F.concat(F.lit("R"), F.col("id").cast("string")).alias("refund_id"),
        F.when(F.col("id") % 3 == 0, F.lit("T1"))
        .otherwise(F.concat(F.lit("T"), (F.col("id") * 7 % N).cast("string"))).alias("original_transaction_id"),
        F.lit("x").alias("customer_id"),
        F.lit("x").alias("product_id"),
        F.make_timestamp_ntz(F.lit(2013), F.lit(6), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).alias("timestamp"),
        F.lit(0.05).alias("refund_amount"),
        F.lit(1).alias("refund_quantity"),
    )
    products = spark.createDataFrame(
        [("PHOT", "Hot", "T1", "v", 1.0)] + [(f"P{i}", f"N{i % 7}", "T2", "v", 1.0) for i in range(50)],
        "product_id string, product_name string, product_type string, product_version string, product_price double",
    )
    customers = spark.createDataFrame(
        [("HOT", "HOT", "ONE", "0")] + [(f"C{i}", "F", str(i), "0") for i in range(500)],
        "customer_id string, customer_first_name string, customer_last_name string, phone_number string",
    )
    return sales, refund, products, customers, sales.toPandas(), refund.toPandas(), products.toPandas()


def _dec(x):
    return Decimal(str(x)).quantize(Decimal("0.01"))


def test_distribution_with_hot_product(skewed):
    sales, _, products, _, ps, _, pp = skewed
    got = {(r.product_name, r.product_type): r.total_amount
           for r in distribution.sales_distribution(sales, products).collect()}
    ps = ps.assign(amt=ps.total_amount.map(_dec)).merge(pp, on="product_id")
    want = ps.groupby(["product_name", "product_type"]).amt.sum()
    assert got == {k: float(v) for k, v in want.items()}


@pytest.mark.parametrize("fan_out", [False, True])
def test_net_per_customer_with_hot_transaction(skewed, fan_out):
    sales, refund, _, customers, ps, pr, _ = skewed
    per = refunds.net_sales_per_customer(sales, refund, 2013, 5, fan_out=fan_out)
    got = {r.customer_id: Decimal(r.net_cents) / 100 for r in per.collect()}
    r = pr.assign(amt=pr.refund_amount.map(_dec)).groupby("original_transaction_id").agg(
        total=("amt", "sum"), k=("amt", "size"))
    s = ps.assign(amt=ps.total_amount.map(_dec)).merge(
        r, left_on="transaction_id", right_index=True, how="left")
    s["k"] = s.k.fillna(0).astype(int)
    s["total"] = s.total.map(lambda v: v if isinstance(v, Decimal) else Decimal("0"))
    mult = s.k.clip(lower=1) if fan_out else 1
    s["net"] = s.amt * mult - s.total
    want = s.groupby("customer_id").net.sum()
    assert got == dict(want.items())
    best = ranking.nth_best_customer(per, customers, 1).collect()
    assert [b.customer_id for b in best] == [max(want.items(), key=lambda kv: kv[1])[0]]


def test_repeats_with_hot_group(skewed):
    sales, _, _, _, ps, _, _ = skewed
    row = repeats.repeat_purchases(sales).collect()[0]
    g = ps.assign(day=ps.timestamp.dt.date).groupby(["day", "product_id", "customer_id"]).size()
    g = g[g >= 2]
    assert (row.n_groups, row.n_users) == (len(g), g.reset_index().customer_id.nunique())


def test_hot_keys_are_combined_before_each_shuffle(skewed):
    sales, refund, products, customers, *_ = skewed
    per = refunds.net_sales_per_customer(sales, refund, 2013, 5)
    plans = [
        plan_text(distribution.sales_distribution(sales, products), "simple"),
        plan_text(ranking.nth_best_customer(per, customers, 2), "simple"),
        plan_text(repeats.repeat_purchases(sales), "simple"),
    ]
    for text in plans:
        lines = text.splitlines()
        for i, line in enumerate(lines):
            if "Exchange hashpartitioning" in line:
                below = lines[i + 1] if i + 1 < len(lines) else ""
                assert "HashAggregate" in below or "Sort" in below or "Exchange" in below, line


def test_hot_order_line_join_is_split_by_aqe(spark, scratch):
    """One order holds a third of all lines: AQE splits that join partition.

    Skew is measured in shuffle bytes, so the hot rows carry distinct part ids (as real
    lines do); a key-only column of one repeated value compresses to nothing.
    """
    import os

    from pyspark.sql import functions as F

    from tillroll.plans.inspect import plan_text
    from tillroll.sources import testdata as td

    n = 60_000
    lines = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).cast("bigint").alias("l_orderkey"),
        F.col("id").cast("bigint").alias("l_partkey"),  # distinct: rows keep their bytes
        F.lit(1).cast("bigint").alias("l_suppkey"),
        F.col("id").cast("int").alias("l_linenumber"),
        F.lit(1.0).alias("l_quantity"),
        (F.col("id") % 100 + 0.5).alias("l_extendedprice"),
    )
    orders = spark.range(n).select(
        F.col("id").alias("o_orderkey"),
        (F.col("id") % 1000).alias("o_custkey"),
        F.to_timestamp_ntz(F.lit("2013-05-01 00:00:00")).alias("o_orderdate"),
    )
    lines.repartition(8).write.parquet(os.path.join(scratch, "lineitem.parquet"))
    orders.repartition(8).write.parquet(os.path.join(scratch, "orders.parquet"))

    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        sales = td.line_sales(spark, scratch)
        df = sales.groupBy("customer_id").agg(F.countDistinct("product_id").alias("n"))
        got = {r.customer_id: r.n for r in df.collect()}
        final = plan_text(df, "simple").split("== Initial Plan ==")[0]
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert "SortMergeJoin" in final and "skew=true" in final, final
    keys = [0 if i % 3 == 0 else i for i in range(n)]
    want = {}
    for k in keys:
        want[k % 1000] = want.get(k % 1000, 0) + 1
    assert got == want
