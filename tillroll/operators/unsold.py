"""Q5: products never sold (optionally: not sold within a period)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from tillroll.functions.periods import restrict


def sold_product_ids(
    sales: DataFrame, start: dt.date | None = None, end: dt.date | None = None
) -> DataFrame:
    """Distinct product ids sold in [start, end); de-duplicated map-side first."""
    if start is not None or end is not None:
        sales = restrict(sales, "timestamp", start, end)
    return sales.select("product_id").distinct()


def unsold_products(
    products: DataFrame,
    sales: DataFrame,
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    """Product rows with no sale (in the period): a left anti join on product_id.

    The reference writes this as an outer join plus ``IS NULL``, which Spark keeps as an
    outer join; the anti join builds a hash side from the distinct sold ids instead.
    """
    return products.join(sold_product_ids(sales, start, end), "product_id", "left_anti")
