"""The six questions as SQL over temp views, the reference's second formulation.

Views: ``product``, ``sales``, ``refund``, ``customer``, ``customer_extnd``, optionally
behind a prefix (an identifier, checked) so they do not replace a caller's own views.
Values go in through named parameters (``spark.sql(text, args=...)``), never by string
splicing; only the small integer ``n`` of a LIMIT is formatted in, after ``int()``.

The statements have the same shapes as the DataFrame operators: sales aggregated per
product before the product join, refunds aggregated per transaction before the sales
join, anti joins for "no refund" and "never sold", the n-th distinct value instead
of a window over every customer, and a one-row [min, max] id filter on the customer
table before the name lookup.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tillroll.functions.money import TOTAL, cents_sql, sum_sql, total_sql

# exact cents back to a double amount
_DOUBLE = f"CAST(CAST({{}} AS {TOTAL}) / 100 AS DOUBLE)"

VIEWS = ("product", "sales", "refund", "customer", "customer_extnd")


def _prefix(prefix: str) -> str:
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*|", prefix):
        raise ValueError(f"view prefix must be an identifier, got {prefix!r}")
    return prefix


def register_views(spark: SparkSession, prefix: str = "", **tables: DataFrame) -> None:
    """``register_views(spark, product=df, sales=df, ...)``; views are named
    ``<prefix><name>`` (a prefix keeps them apart from the caller's own views)."""
    prefix = _prefix(prefix)
    for name, df in tables.items():
        if name not in VIEWS:
            raise ValueError(f"unknown view {name!r}; expected one of {VIEWS}")
        df.createOrReplaceTempView(f"{prefix}{name}")


def sales_distribution(
    spark: SparkSession, keep_unsold: bool = True, prefix: str = ""
) -> DataFrame:
    p = _prefix(prefix)
    join = "LEFT JOIN" if keep_unsold else "JOIN"
    return spark.sql(
        f"""
        WITH per_product AS (
          SELECT product_id, {total_sql("total_amount")} AS amount
          FROM {p}sales GROUP BY product_id)
        SELECT p.product_name, p.product_type, {_DOUBLE.format(sum_sql('s.amount'))} AS total_sales
        FROM {p}product p {join} per_product s ON s.product_id = p.product_id
        GROUP BY p.product_name, p.product_type
        ORDER BY total_sales DESC NULLS LAST, product_name, product_type
        """
    )


def _refund_scope(since: int | None) -> str:
    if since is None:
        return ""
    return "WHERE timestamp >= make_timestamp_ntz(:since, 1, 1, 0, 0, 0)"


def unrefunded_total(
    spark: SparkSession, year: int, since: int | None = None, prefix: str = ""
) -> DataFrame:
    p = _prefix(prefix)
    args = {"year": year}
    if since is not None:
        args["since"] = since
    return spark.sql(
        f"""
        SELECT {_DOUBLE.format(total_sql('s.total_amount'))} AS total_amount
        FROM {p}sales s
        LEFT ANTI JOIN (SELECT DISTINCT original_transaction_id FROM {p}refund
                        {_refund_scope(since)}) r
          ON s.transaction_id = r.original_transaction_id
        WHERE s.timestamp >= make_timestamp_ntz(:year, 1, 1, 0, 0, 0)
          AND s.timestamp < make_timestamp_ntz(:year + 1, 1, 1, 0, 0, 0)
        """,
        args=args,
    )


def nth_best_customer(
    spark: SparkSession,
    year: int,
    month: int,
    n: int = 2,
    since: int | None = None,
    fan_out: bool = False,
    prefix: str = "",
    keep_rank: bool = False,
) -> DataFrame:
    """``keep_rank`` adds the column ``dense_rank`` (n in every row), as the reference's SQL
    returns it."""
    p = _prefix(prefix)
    args = {"year": year, "month": month, "n": int(n)}
    if since is not None:
        args["since"] = since
    amount = cents_sql("s.total_amount")
    if fan_out:
        amount = f"CAST({amount} * greatest(coalesce(r.n_refunds, 1L), 1L) AS {TOTAL})"
    # only refunds of the month's transactions are aggregated and shuffled
    month = """timestamp >= make_timestamp_ntz(:year, :month, 1, 0, 0, 0)
            AND timestamp < make_timestamp_ntz(:year, :month, 1, 0, 0, 0) + INTERVAL 1 MONTH"""
    net = sum_sql(f"CAST({amount} - coalesce(r.refund_total, 0) AS {TOTAL})")
    return spark.sql(
        f"""
        WITH month_sales AS (SELECT * FROM {p}sales WHERE {month}),
        per_tx AS (
          SELECT original_transaction_id AS transaction_id,
                 {total_sql("refund_amount")} AS refund_total,
                 count(*) AS n_refunds
          FROM (SELECT * FROM {p}refund {_refund_scope(since)}) r
          LEFT SEMI JOIN month_sales m ON r.original_transaction_id = m.transaction_id
          GROUP BY original_transaction_id),
        net AS (
          SELECT s.customer_id,
                 {net} AS net_total
          FROM month_sales s LEFT JOIN per_tx r ON s.transaction_id = r.transaction_id
          WHERE s.customer_id IS NOT NULL
          GROUP BY s.customer_id),
        nth AS (
          SELECT min(net_total) AS value FROM (
            SELECT DISTINCT net_total FROM net WHERE net_total IS NOT NULL
            ORDER BY net_total DESC LIMIT {int(n)})
          HAVING count(*) = :n),
        ranked AS (
          SELECT net.* FROM net JOIN nth ON net.net_total = nth.value),
        bounds AS (
          SELECT min(customer_id) AS lo, max(customer_id) AS hi FROM ranked),
        names AS (
          SELECT /*+ BROADCAST(b) */ c.customer_id,
                 concat_ws(' ', c.customer_first_name, c.customer_last_name) AS customer_name
          FROM {p}customer c JOIN bounds b ON c.customer_id BETWEEN b.lo AND b.hi)
        SELECT ranked.customer_id, names.customer_name,
               {_DOUBLE.format('ranked.net_total')} AS net_total
               {", CAST(:n AS INT) AS dense_rank" if keep_rank else ""}
        FROM ranked JOIN names ON names.customer_id = ranked.customer_id
        """,
        args=args,
    )


def unsold_products(spark: SparkSession, prefix: str = "") -> DataFrame:
    p = _prefix(prefix)
    return spark.sql(
        f"""
        SELECT p.* FROM {p}product p
        LEFT ANTI JOIN (SELECT DISTINCT product_id FROM {p}sales) s
          ON p.product_id = s.product_id
        """
    )


def repeat_purchases(spark: SparkSession, min_count: int = 2, prefix: str = "") -> DataFrame:
    p = _prefix(prefix)
    return spark.sql(
        f"""
        SELECT count(*) AS n_groups, count(DISTINCT customer_id) AS n_users
        FROM (SELECT to_date(timestamp) AS sale_day, product_id, customer_id,
                     count(*) AS n_purchases
              FROM {p}sales GROUP BY to_date(timestamp), product_id, customer_id
              HAVING n_purchases >= :min_count)
        """,
        args={"min_count": min_count},
    )


def consecutive_purchases(
    spark: SparkSession, min_days: int = 2, gap_days: int = 1, prefix: str = ""
) -> DataFrame:
    """The streaks of ``operators.repeats.consecutive_purchases``."""
    p = _prefix(prefix)
    return spark.sql(
        f"""
        WITH days AS (
          SELECT customer_id, product_id, to_date(timestamp) AS sale_day, count(*) AS n
          FROM {p}sales
          WHERE customer_id IS NOT NULL AND product_id IS NOT NULL AND timestamp IS NOT NULL
          GROUP BY customer_id, product_id, to_date(timestamp)),
        ends AS (
          SELECT *, coalesce(datediff(sale_day, lag(sale_day) OVER w) > :gap_days, true) AS is_start,
                 coalesce(datediff(lead(sale_day) OVER w, sale_day) > :gap_days, true) AS is_last,
                 CAST(row_number() OVER w AS BIGINT) AS day,
                 sum(n) OVER (PARTITION BY customer_id, product_id ORDER BY sale_day
                              ROWS UNBOUNDED PRECEDING) AS bought
          FROM days WINDOW w AS (PARTITION BY customer_id, product_id ORDER BY sale_day)),
        started AS (
          SELECT *, last(CASE WHEN is_start THEN struct(sale_day, day - 1 AS day, bought - n AS bought) END, true)
                      OVER (PARTITION BY customer_id, product_id ORDER BY sale_day
                            ROWS UNBOUNDED PRECEDING) AS start
          FROM ends)
        SELECT customer_id, product_id, start.sale_day AS first_day, sale_day AS last_day,
               day - start.day AS n_days, bought - start.bought AS n_purchases
        FROM started WHERE is_last AND day - start.day >= :min_days
        """,
        args={"min_days": min_days, "gap_days": gap_days},
    )


def customers_at_address(spark: SparkSession, street: str, prefix: str = "") -> DataFrame:
    p = _prefix(prefix)
    return spark.sql(
        f"SELECT * FROM {p}customer_extnd "
        "WHERE upper(current_address.street_address) = upper(:street)",
        args={"street": street},
    )
