"""tillroll: retail sales and refund analytics as Spark DataFrame jobs.

    from tillroll import load_text_tables, answers
    tables = load_text_tables(spark, "/data/dir")          # Product.txt, Sales.txt, ...
    for title, df in answers(tables, year=2013, month=5).items():
        df.show()
"""

from tillroll.operators import (
    clean_customers_extended,
    customers_at_address,
    dq_report,
    net_sales_per_customer,
    nth_best_customer,
    repeat_purchase_groups,
    repeat_purchases,
    sales_distribution,
    top_sales_distribution,
    unrefunded_sales,
    unrefunded_total,
    unsold_products,
)
from tillroll.report import answers
from tillroll.sources.ingest import ingest, load, load_bucketed, load_text_tables
from tillroll.sources.text import parse, read_lines

__version__ = "0.1.0"

__all__ = [
    "answers",
    "clean_customers_extended",
    "customers_at_address",
    "dq_report",
    "ingest",
    "load",
    "load_bucketed",
    "load_text_tables",
    "net_sales_per_customer",
    "nth_best_customer",
    "parse",
    "read_lines",
    "repeat_purchase_groups",
    "repeat_purchases",
    "sales_distribution",
    "top_sales_distribution",
    "unrefunded_sales",
    "unrefunded_total",
    "unsold_products",
]
