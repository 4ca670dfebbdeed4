"""Q2: sales distribution by product name and product type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.money import as_double, sum_cents, total


def sales_per_product(sales: DataFrame) -> DataFrame:
    """Exact total per product id, in cents. Partial aggregation runs before the shuffle,
    so a product with a third of all sales still ships one row per map task."""
    return sales.groupBy("product_id").agg(total("total_amount").alias("_amount"))


def sales_distribution(
    sales: DataFrame,
    products: DataFrame,
    keep_unsold: bool = False,
    amount_name: str = "total_amount",
    ordered: bool = True,
) -> DataFrame:
    """Sum of ``total_amount`` per (product_name, product_type), largest first.

    Sales are aggregated per product before the join, so the join sees one row per
    product instead of one per sale. ``keep_unsold`` keeps products without sales (their
    amount is NULL), as the SQL formulation of the question does.
    """
    names = products.select("product_id", "product_name", "product_type")
    per_product = sales_per_product(sales)
    if keep_unsold:
        joined = names.join(per_product, "product_id", "left")
    else:
        joined = per_product.join(names, "product_id")
    out = joined.groupBy("product_name", "product_type").agg(
        as_double(sum_cents("_amount")).alias(amount_name)
    )
    if ordered:
        out = out.orderBy(
            F.desc_nulls_last(amount_name), F.asc("product_name"), F.asc("product_type")
        )
    return out


def top_sales_distribution(
    sales: DataFrame, products: DataFrame, n: int = 25, **kwargs
) -> DataFrame:
    """The ``n`` largest groups; ties broken by name and type so the cut is stable.
    Planned as a per-partition top-n followed by one merge (TakeOrderedAndProject)."""
    return sales_distribution(sales, products, ordered=True, **kwargs).limit(n)
