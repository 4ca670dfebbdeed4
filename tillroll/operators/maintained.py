"""Totals kept per month and brought up to date batch by batch.

State: partial sums, written below a folder as they become known and added up on reading.

* ``gross``: (month, customer_id, product_id, gross, n_sales) of the sales of a batch;
* ``refunds``: (month, customer_id, refunded, refunded_since) by the *sale's* month, for each
  pair of a refund batch and a sale batch: a late refund changes the month of its sale, a
  refund that arrives before its sale counts when the sale does.  ``refunded_since`` counts
  only refunds dated in the sale's year or later.

``update_totals`` of a batch replaces exactly the partials that the batch takes part in, so a
rerun (with other rows, or none) leaves the state as if the batch had come like that at first.
It reads the batch's sales and refunds, of the other batches' sales the id, customer and time,
and of their refunds only those of the batch's transactions.  Sums are exact decimal cents, so
they do not depend on how the rows are dealt over batches.

The reader functions touch the partials alone, which are as many as (month, customer) pairs
and batches, not sales.  The fan-out variant of the monthly ranking and the unrefunded total
are no sums of such partials and stay with ``operators.refunds``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.money import as_double, cents, sum_cents, total
from tillroll.functions.periods import month_key
from tillroll.operators.refunds import SAME_YEAR
from tillroll.session import matching_paths, remove_path
from tillroll.sources.batches import BATCH, _key, write_batch

SALE_BATCH, REFUND_BATCH = "_sale_batch", "_refund_batch"
_CENTS = T.DecimalType(34, 8)
_GROSS = "month int, customer_id string, product_id string, gross decimal(34,8), n_sales long, _batch string"
_REFUNDS = (
    "month int, customer_id string, refunded decimal(34,8), refunded_since decimal(34,8), "
    "_refund_batch string, _sale_batch string"
)


def _text(c: str) -> Column:
    return F.col(c).cast("string").alias(c)


def update_totals(state_dir: str, batch: str, sales: DataFrame, refunds: DataFrame) -> None:
    """Bring the partials of one batch up to date; ``sales`` and ``refunds`` are the tables of
    all batches with their ``_batch`` (``sources.batches.load_batches``)."""
    spark, base, key = sales.sparkSession, state_dir.rstrip("/"), _key(batch)
    own_sales = sales.filter(F.col(BATCH) == key)
    gross = (
        own_sales.groupBy(month_key("timestamp").alias("month"), "customer_id", "product_id")
        .agg(total("total_amount").alias("gross"), F.count(F.lit(1)).alias("n_sales"))
        .select("month", _text("customer_id"), _text("product_id"), "gross", "n_sales")
    )
    remove_path(spark, f"{base}/gross/{BATCH}={key}")
    write_batch(gross, f"{base}/gross", key)

    # ids become text only after the shuffles, and of the time only month and year are joined
    slim = sales.select(
        F.col("transaction_id").alias("original_transaction_id"), "customer_id",
        month_key("timestamp").alias("month"), F.year("timestamp").alias("sold"),
        F.col(BATCH).alias(SALE_BATCH),
    )
    own = F.col(SALE_BATCH) == key
    # the amount of any refund is checked, with a sale or without
    amount = F.when(cents("refund_amount").isNotNull(), F.col("refund_amount")).alias("refund_amount")
    back = refunds.select(
        "original_transaction_id", F.year("timestamp").alias("year"), amount, F.col(BATCH).alias(REFUND_BATCH)
    )
    # the batch's sales meet all refunds, the other sales its own refunds: no sale is shuffled
    # twice, and sums are taken after the join, where a refund has been shuffled once
    with_own = back.filter(F.col(REFUND_BATCH).isNotNull()).join(slim.filter(own), "original_transaction_id")
    with_others = back.filter(F.col(REFUND_BATCH) == key).join(
        slim.filter(~F.coalesce(own, F.lit(False))), "original_transaction_id"
    )
    columns = ["month", "sold", "customer_id", "year", "refund_amount", REFUND_BATCH, SALE_BATCH]
    paired = (
        with_own.select(*columns).union(with_others.select(*columns))
        .groupBy("month", "customer_id", REFUND_BATCH, SALE_BATCH)
        .agg(
            total("refund_amount").alias("refunded"),
            total(F.when(F.col("year") >= F.col("sold"), F.col("refund_amount")).otherwise(F.lit(0.0)))
            .alias("refunded_since"),
        )
        .select("month", _text("customer_id"), "refunded", "refunded_since", REFUND_BATCH, SALE_BATCH)
    )
    folders = [f"{base}/refunds/{REFUND_BATCH}={key}"]
    folders += matching_paths(spark, f"{base}/refunds/{REFUND_BATCH}=*/{SALE_BATCH}={key}")
    for folder in folders:
        remove_path(spark, folder)
    writer = paired.write.mode("append").option("compression", "zstd")
    writer.partitionBy(REFUND_BATCH, SALE_BATCH).parquet(f"{base}/refunds")


def _partials(spark: SparkSession, state_dir: str, name: str, schema: str) -> DataFrame:
    path = f"{state_dir.rstrip('/')}/{name}"
    if not matching_paths(spark, f"{path}/_*=*"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def maintained_net_per_customer(
    spark: SparkSession, state_dir: str, year: int, month: int, refunds_since=SAME_YEAR
) -> DataFrame:
    """(customer_id, net_cents) of one month, equal to ``refunds.net_sales_per_customer`` over
    all batches (customer ids as text).  ``refunds_since``: the sale's year, or None for any."""
    if refunds_since not in (SAME_YEAR, None):
        raise ValueError("partials know refunds of the sale's year or later, or all of them")
    of_month = F.col("month") == year * 100 + month
    refunded = "refunded" if refunds_since is None else "refunded_since"
    gross = _partials(spark, state_dir, "gross", _GROSS).filter(of_month)
    back = _partials(spark, state_dir, "refunds", _REFUNDS).filter(of_month)
    signed = gross.select("customer_id", F.col("gross").alias("cents")).union(
        back.select("customer_id", (-F.col(refunded)).cast(_CENTS).alias("cents"))
    )
    return (
        signed.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id").agg(sum_cents("cents").alias("net_cents"))
    )


def maintained_sales_distribution(spark: SparkSession, state_dir: str, products: DataFrame) -> DataFrame:
    """(product_name, product_type, total_amount), equal to
    ``distribution.sales_distribution`` (unordered) over all batches."""
    per_product = (
        _partials(spark, state_dir, "gross", _GROSS)
        .groupBy("product_id").agg(sum_cents("gross").alias("cents"))
    )
    names = products.select(_text("product_id"), "product_name", "product_type")
    return (
        per_product.join(names, "product_id").groupBy("product_name", "product_type")
        .agg(as_double(sum_cents("cents")).alias("total_amount"))
    )
