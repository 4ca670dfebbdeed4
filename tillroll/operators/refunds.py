"""Q3 and the refund side of Q4: sales netted against their refunds.

Refund scope: the DataFrame formulation of the reference counts only refunds dated in
the sales year or later, the SQL formulation counts every refund. ``refunds_since``
selects between them: ``"year"`` (default, the year asked for), an explicit year, or
``None`` for any refund.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.money import TOTAL, as_double, cents, checked, sum_cents, total
from tillroll.functions.periods import month_bounds, restrict, year_bounds

SAME_YEAR = "year"


def _scoped(refunds: DataFrame, year: int, refunds_since: int | str | None) -> DataFrame:
    if refunds_since is None:
        return refunds
    since = year if refunds_since == SAME_YEAR else int(refunds_since)
    return restrict(refunds, "timestamp", dt.date(since, 1, 1), None)


def refunded_transactions(refunds: DataFrame) -> DataFrame:
    """Distinct refunded transaction ids, de-duplicated map-side before the shuffle."""
    return refunds.select(F.col("original_transaction_id").alias("transaction_id")).distinct()


def refunds_per_transaction(refunds: DataFrame) -> DataFrame:
    """One row per refunded transaction: refund total in cents and number of refunds."""
    return refunds.groupBy(F.col("original_transaction_id").alias("transaction_id")).agg(
        total("refund_amount").alias("refund_cents"),
        F.count(F.lit(1)).alias("n_refunds"),
    )


def unrefunded_sales(
    sales: DataFrame, refunds: DataFrame, year: int, refunds_since=SAME_YEAR
) -> DataFrame:
    """Sales of ``year`` with no refund in scope (a left anti join)."""
    year_sales = restrict(sales, "timestamp", *year_bounds(year))
    refunded = refunded_transactions(_scoped(refunds, year, refunds_since))
    return year_sales.join(refunded, "transaction_id", "left_anti")


def unrefunded_total(
    sales: DataFrame, refunds: DataFrame, year: int, refunds_since=SAME_YEAR
) -> DataFrame:
    """Q3: one row, ``total_amount`` of the unrefunded sales of ``year`` (NULL if none)."""
    return unrefunded_sales(sales, refunds, year, refunds_since).agg(
        as_double(total("total_amount")).alias("total_amount")
    )


def net_sales(
    sales: DataFrame,
    refunds: DataFrame,
    year: int,
    month: int,
    refunds_since=SAME_YEAR,
    fan_out: bool = False,
) -> DataFrame:
    """Sales of one month with ``net`` = amount minus refunds, in cents.

    Refunds are aggregated per transaction before the join, so the join is one-to-one.
    ``fan_out=True`` gives the reference's number, where a sale with k refunds is counted
    k times (once per joined refund row): k * amount - sum(refunds). It is computed from
    the same aggregate, without materialising the fanned-out rows.
    """
    month_sales = restrict(sales, "timestamp", *month_bounds(year, month))
    # only the month's transactions: their ids reach the refunds' side before its shuffle
    # (broadcast, or a runtime filter, as their measured size allows)
    ids = month_sales.select(F.col("transaction_id").alias("original_transaction_id"))
    scoped = _scoped(refunds, year, refunds_since).join(ids, "original_transaction_id", "left_semi")
    per_tx = refunds_per_transaction(scoped)
    joined = month_sales.join(per_tx, "transaction_id", "left")
    refunded = F.coalesce(F.col("refund_cents"), F.lit(0).cast(TOTAL))
    amount = cents("total_amount")
    if fan_out:
        times = F.greatest(F.coalesce(F.col("n_refunds"), F.lit(1)), F.lit(1))
        amount = F.when(amount.isNotNull(), checked((amount * times).try_cast(TOTAL)))
    return joined.withColumn("net", (amount - refunded).cast(TOTAL))


def net_sales_per_customer(
    sales: DataFrame,
    refunds: DataFrame,
    year: int,
    month: int,
    refunds_since=SAME_YEAR,
    fan_out: bool = False,
) -> DataFrame:
    """(customer_id, net_cents) for one month; exact cents, so ranks and ties are exact.

    Sales without a customer id are left out (text input never has one; a NULL id is
    no customer to rank). Stating it here also keeps both uses of this aggregate in the
    ranking plan identical, so its shuffle is computed once and reused.
    """
    return (
        net_sales(sales, refunds, year, month, refunds_since, fan_out)
        .filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(sum_cents("net").alias("net_cents"))
    )
