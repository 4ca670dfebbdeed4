from tillroll.operators.address import customers_at_address
from tillroll.operators.distribution import sales_distribution, top_sales_distribution
from tillroll.operators.quality import clean_customers_extended, dq_report
from tillroll.operators.ranking import nth_best_customer
from tillroll.operators.refunds import (
    net_sales_per_customer,
    unrefunded_sales,
    unrefunded_total,
)
from tillroll.operators.repeats import repeat_purchase_groups, repeat_purchases
from tillroll.operators.unsold import unsold_products

__all__ = [
    "clean_customers_extended",
    "customers_at_address",
    "dq_report",
    "net_sales_per_customer",
    "nth_best_customer",
    "repeat_purchase_groups",
    "repeat_purchases",
    "sales_distribution",
    "top_sales_distribution",
    "unrefunded_sales",
    "unrefunded_total",
    "unsold_products",
]
