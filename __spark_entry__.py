"""


Every query reads whole tables of ``sf_dir`` (through the mapping in
``tillroll.sources.testdata``); the parameters below are the question's own
(year, month, rank, repeat count, address), with 1997 standing in for the
reference's 2013.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

# the package sits next to this file; make it importable however this file is loaded
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tillroll.functions.clean import US_STATES
from tillroll.functions.money import as_double
from tillroll.functions.periods import PERIOD, month_bounds, month_key, restrict
from tillroll.operators import address, distribution, maintained, quality, ranking, refunds
from tillroll.operators import repeats, unsold
from tillroll.plans import sql as S
from tillroll.plans import text_sql
from tillroll.session import scratch_dir
from tillroll.sources import batches, statistics
from tillroll.sources import testdata as td
from tillroll.sources.ingest import STATUS
from tillroll.sources.schema import CUSTOMER_EXTENDED, SPECS
from tillroll.sources.text import flatten_struct, parse

# the training-data operators and their pipeline are optional parts of a checkout: only
# their own absence is accepted, any other import error is raised
try:
    import corpus_pipeline
    from tillroll.llm import entry as llm_entry
except ModuleNotFoundError as missing:
    if missing.name not in {"corpus_pipeline", "tillroll.llm", "tillroll.llm.entry"}:
        raise
    corpus_pipeline = llm_entry = None

SMOKE_DIR = "/root/testdata/sf0.001"

YEAR = 1997
MONTH = 5
RANK = 2
MIN_REPEATS = 2
STREAK_GAP = 60  # days between the purchases of a streak
TOP = 25
STREET = "42 Furniture blvd"


# --------------------------------------------------------------------------- helpers


def _flat_ce(df: DataFrame) -> DataFrame:
    for s in ("current_address", "permanent_address", "office_address"):
        df = flatten_struct(df, s)
    return df


def _per_customer(spark, d, since="year", fan_out=False):
    return refunds.net_sales_per_customer(
        td.order_sales(spark, d), td.refunds(spark, d), YEAR, MONTH, since, fan_out
    )


def _second_best(spark, d, since="year", fan_out=False, method="dense"):
    return ranking.nth_best_customer(
        _per_customer(spark, d, since, fan_out), td.customers(spark, d), RANK, method
    )


# the SQL-formulation queries register their views under this prefix, so they never
# replace temp views of the same name in the caller's session
VIEW_PREFIX = "tillroll_"


def _views(spark, d, sales):
    S.register_views(
        spark,
        VIEW_PREFIX,
        product=td.products(spark, d),
        sales=sales,
        refund=td.refunds(spark, d),
        customer=td.customers(spark, d),
        customer_extnd=td.customers_extended(spark, d),
    )


def _month_sales(spark, d):
    """One month's sales: over all of them every product is sold."""
    return restrict(td.line_sales(spark, d), "timestamp", *month_bounds(YEAR, MONTH))


# --------------------------------------------------------------------------- queries


def q_sales_distribution(spark, d):
    return distribution.sales_distribution(
        td.line_sales(spark, d, with_order=False), td.products(spark, d)
    )


def q_sales_distribution_all_products(spark, d):
    _views(spark, d, _month_sales(spark, d))
    return S.sales_distribution(spark, keep_unsold=True, prefix=VIEW_PREFIX)


def q_sales_distribution_top25(spark, d):
    return distribution.top_sales_distribution(
        td.line_sales(spark, d, with_order=False), td.products(spark, d), TOP
    )


def q_unrefunded_total(spark, d):
    return refunds.unrefunded_total(td.order_sales(spark, d), td.refunds(spark, d), YEAR)


def q_unrefunded_total_any_refund(spark, d):
    return refunds.unrefunded_total(
        td.order_sales(spark, d), td.refunds(spark, d), YEAR, refunds_since=None
    )


def q_unrefunded_total_sql(spark, d):
    _views(spark, d, td.order_sales(spark, d))
    return S.unrefunded_total(spark, YEAR, since=None, prefix=VIEW_PREFIX)


def q_net_sales_per_customer(spark, d):
    return _per_customer(spark, d).select("customer_id", as_double("net_cents").alias("net_total"))


def q_second_best_customer(spark, d):
    return _second_best(spark, d)


def q_second_best_customer_fan_out(spark, d):
    return _second_best(spark, d, fan_out=True)


def q_second_best_customer_row_number(spark, d):
    return _second_best(spark, d, method="row")


def q_second_best_customer_any_refund(spark, d):
    return _second_best(spark, d, since=None)


def q_second_best_customer_sql(spark, d):
    _views(spark, d, td.order_sales(spark, d))
    return S.nth_best_customer(
        spark, YEAR, MONTH, RANK, since=None, fan_out=True, prefix=VIEW_PREFIX, keep_rank=True
    )


def q_unsold_products(spark, d):
    return unsold.unsold_products(
        td.products(spark, d), td.line_sales(spark, d, with_order=False)
    )


def q_unsold_products_in_month(spark, d):
    start, end = month_bounds(YEAR, MONTH)
    return unsold.unsold_products(td.products(spark, d), td.line_sales(spark, d), start, end)


def q_unsold_products_sql(spark, d):
    _views(spark, d, _month_sales(spark, d))
    return S.unsold_products(spark, prefix=VIEW_PREFIX)


def q_repeat_purchases(spark, d):
    return repeats.repeat_purchases(td.line_sales(spark, d), MIN_REPEATS)


def q_repeat_purchase_groups(spark, d):
    return repeats.repeat_purchase_groups(td.line_sales(spark, d), MIN_REPEATS)


def q_repeat_purchases_sql(spark, d):
    _views(spark, d, td.line_sales(spark, d))
    return S.repeat_purchases(spark, MIN_REPEATS, prefix=VIEW_PREFIX)


def q_consecutive_purchases(spark, d):
    return repeats.consecutive_purchases(td.line_sales(spark, d), MIN_REPEATS)


def q_purchase_streaks(spark, d):
    return repeats.consecutive_purchases(td.line_sales(spark, d), MIN_REPEATS, STREAK_GAP)


def q_purchase_streaks_sql(spark, d):
    _views(spark, d, td.line_sales(spark, d))
    return S.consecutive_purchases(spark, MIN_REPEATS, STREAK_GAP, prefix=VIEW_PREFIX)


def _maintained(spark, sales, back):
    """State of the totals after three batches by time, as they would arrive: the refunds of
    a sale may come with a later batch, or with an earlier one."""
    state, ts = scratch_dir(spark, "totals"), F.year("timestamp")
    batch = F.when(ts < 1995, "a").when(ts < YEAR, "b").otherwise("c").alias(batches.BATCH)
    sales, back = sales.select("*", batch), back.select("*", batch)
    for key in "abc":
        so_far = F.col(batches.BATCH) <= key
        maintained.update_totals(state, key, sales.filter(so_far), back.filter(so_far))
    return state


def q_net_sales_maintained(spark, d):
    sales = td.order_sales(spark, d).withColumn("product_id", F.lit(None).cast("string"))
    state = _maintained(spark, sales, td.refunds(spark, d))
    net = maintained.maintained_net_per_customer(spark, state, YEAR, MONTH)
    return net.select(F.col("customer_id").cast("long"), as_double("net_cents").alias("net_total"))


def q_net_sales_registered(spark, d):
    """Sales and refunds by month in the catalog, with statistics: the month's folder is
    chosen, and its ids may filter the refunds, while the query is planned."""
    base = scratch_dir(spark, "registered")
    prefix = f"{VIEW_PREFIX}{base.rsplit('-', 1)[1]}_"
    for name, rows in (("sales", td.order_sales(spark, d)), ("refund", td.refunds(spark, d))):
        missing = [f for f in SPECS[name].schema().fields if f.name not in rows.columns]
        nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in missing]
        months = rows.select("*", *nulls, F.lit("ok").alias(STATUS), month_key("timestamp").alias(PERIOD))
        months.hint("rebalance", PERIOD).write.partitionBy(STATUS, PERIOD).parquet(f"{base}/{name}")
    statistics.register(spark, base, table_prefix=prefix)
    sales, back = (statistics.load_registered(spark, n, prefix) for n in ("sales", "refund"))
    net = refunds.net_sales_per_customer(sales, back, YEAR, MONTH)
    return net.select("customer_id", as_double("net_cents").alias("net_total"))


def q_sales_distribution_maintained(spark, d):
    back = td.refunds(spark, d).withColumn("original_transaction_id", F.col("refund_id"))
    # lines and orders are joined once; every batch reads the sales of those before it again
    path, sales = scratch_dir(spark, "lines"), td.line_sales(spark, d).drop("total_quantity")
    sales.write.option("compression", "zstd").parquet(path)
    state = _maintained(spark, spark.read.schema(sales.schema).parquet(path), back)
    return maintained.maintained_sales_distribution(spark, state, td.products(spark, d))


def q_customers_at_address(spark, d):
    return _flat_ce(address.customers_at_address(td.customers_extended(spark, d), STREET))


def q_customers_at_address_sql(spark, d):
    _views(spark, d, td.order_sales(spark, d))
    return _flat_ce(S.customers_at_address(spark, STREET, prefix=VIEW_PREFIX))


def q_parse_sales_lines(spark, d):
    return parse(td.sales_lines(spark, d), "sales").good


def q_parse_refund_lines(spark, d):
    return parse(td.refund_lines(spark, d), "refund").good


def q_parse_product_lines(spark, d):
    return parse(td.product_lines(spark, d), "product").good


def q_parse_customer_lines(spark, d):
    return parse(td.customer_lines(spark, d), "customer").good


def q_parse_customer_extended_lines(spark, d):
    return _flat_ce(parse(td.customer_extended_lines(spark, d), CUSTOMER_EXTENDED).good)


def _parse_by_sql(name):
    def query(spark, d):
        lines = getattr(td, f"{name}_lines")(spark, d)
        good = text_sql.parse_lines(spark, lines, name, VIEW_PREFIX)
        return _flat_ce(good) if name == "customer_extended" else good

    return query


def q_quarantined_lines_sql(spark, d):
    lines = td.sales_lines(spark, d, dirty=True)
    bad = text_sql.quarantined_lines(spark, lines, "sales", VIEW_PREFIX)
    return bad.select(F.substring_index("value", "|", 1).alias("transaction_id"), "reason")


def _ingest_dq(name):
    """The report that the ingest of a batch gives from its own pass over the lines."""

    def query(spark, d):
        dirty = {"dirty": True} if name == "sales" else {}
        lines = getattr(td, f"{name}_lines")(spark, d, **dirty)
        return batches.ingest_lines(lines, name, scratch_dir(spark, "batch"), "all")

    return query


def q_quarantined_lines(spark, d):
    bad = parse(td.sales_lines(spark, d, dirty=True), "sales").bad
    return bad.select(
        F.substring_index("value", "|", 1).alias("transaction_id"), "reason"
    )


def q_dq_report_sales(spark, d):
    return quality.dq_report(td.sales_lines(spark, d, dirty=True), SPECS["sales"])


def q_dq_report_refund(spark, d):
    return quality.dq_report(td.refund_lines(spark, d), SPECS["refund"])


def q_dq_report_product(spark, d):
    return quality.dq_report(td.product_lines(spark, d), SPECS["product"])


def q_dq_report_customer(spark, d):
    return quality.dq_report(td.customer_lines(spark, d), SPECS["customer"])


def q_dq_report_customer_extended(spark, d):
    return quality.dq_report(td.customer_extended_lines(spark, d), CUSTOMER_EXTENDED)


def _clean_ce(spark, d):
    return quality.clean_customers_extended(td.customers_extended(spark, d))


def q_clean_addresses(spark, d):
    c = _clean_ce(spark, d)
    return c.select(
        "id",
        F.col("current_address.street_address").alias("current_street_address"),
        F.col("permanent_address.street_address").alias("permanent_street_address"),
        F.col("office_address.street_address").alias("office_street_address"),
    )


def q_clean_state_codes(spark, d):
    c = _clean_ce(spark, d)
    return c.select(
        "id",
        F.col("current_address.state").alias("current_state"),
        F.col("permanent_address.state").alias("permanent_state"),
        F.col("office_address.state").alias("office_state"),
    )


def q_clean_state_codes_from_table(spark, d):
    lookup = spark.createDataFrame(list(US_STATES), "name string, code string")
    c = quality.state_codes_from(td.customers_extended(spark, d), lookup)
    return c.select(
        "id",
        F.col("current_address.state").alias("current_state"),
        F.col("permanent_address.state").alias("permanent_state"),
        F.col("office_address.state").alias("office_state"),
    )


def q_flag_invalid_contacts(spark, d):
    c = _clean_ce(spark, d)
    return c.select(
        "id",
        "personal_email_address",
        "work_email_address",
        "twitter_id",
        "facebook_id",
        "linkedin_id",
    )


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "sales_distribution": q_sales_distribution,
    "sales_distribution_all_products": q_sales_distribution_all_products,
    "sales_distribution_top25": q_sales_distribution_top25,
    "unrefunded_total": q_unrefunded_total,
    "unrefunded_total_any_refund": q_unrefunded_total_any_refund,
    "unrefunded_total_sql": q_unrefunded_total_sql,
    "net_sales_per_customer": q_net_sales_per_customer,
    "second_best_customer": q_second_best_customer,
    "second_best_customer_fan_out": q_second_best_customer_fan_out,
    "second_best_customer_row_number": q_second_best_customer_row_number,
    "second_best_customer_any_refund": q_second_best_customer_any_refund,
    "second_best_customer_sql": q_second_best_customer_sql,
    "unsold_products": q_unsold_products,
    "unsold_products_in_month": q_unsold_products_in_month,
    "unsold_products_sql": q_unsold_products_sql,
    "repeat_purchases": q_repeat_purchases,
    "repeat_purchase_groups": q_repeat_purchase_groups,
    "repeat_purchases_sql": q_repeat_purchases_sql,
    "customers_at_address": q_customers_at_address,
    "customers_at_address_sql": q_customers_at_address_sql,
    "parse_sales_lines": q_parse_sales_lines,
    "parse_refund_lines": q_parse_refund_lines,
    "parse_product_lines": q_parse_product_lines,
    "parse_customer_lines": q_parse_customer_lines,
    "parse_customer_extended_lines": q_parse_customer_extended_lines,
    "quarantined_lines": q_quarantined_lines,
    "dq_report_sales": q_dq_report_sales,
    "dq_report_refund": q_dq_report_refund,
    "dq_report_product": q_dq_report_product,
    "dq_report_customer": q_dq_report_customer,
    "dq_report_customer_extended": q_dq_report_customer_extended,
    "clean_addresses": q_clean_addresses,
    "clean_state_codes": q_clean_state_codes,
    "flag_invalid_contacts": q_flag_invalid_contacts,
    "consecutive_purchases": q_consecutive_purchases,
    "purchase_streaks": q_purchase_streaks,
    "purchase_streaks_sql": q_purchase_streaks_sql,
    "net_sales_maintained": q_net_sales_maintained,
    "net_sales_registered": q_net_sales_registered,
    "sales_distribution_maintained": q_sales_distribution_maintained,
    **{f"parse_{name}_lines_sql": _parse_by_sql(name) for name in SPECS},
    "quarantined_lines_sql": q_quarantined_lines_sql,
    **{f"ingest_dq_{name}": _ingest_dq(name) for name in SPECS},
    "clean_state_codes_from_table": q_clean_state_codes_from_table,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query (sales distribution by product name and type) on sf0.001."""
    return q_sales_distribution(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    if llm_entry is None:
        return dict(_QUERIES)
    return {**_QUERIES, **llm_entry.QUERIES, "pipeline": corpus_pipeline.run}


# --------------------------------------------------------------------------- oracle SQL
# DuckDB formulations written independently of the Spark code: plain joins in the
# reference's own shape (outer join + IS NULL, fan-out joins, dense_rank windows).

_Y0 = f"TIMESTAMP '{YEAR}-01-01'"
_Y1 = f"TIMESTAMP '{YEAR + 1}-01-01'"
_M0 = f"TIMESTAMP '{YEAR}-{MONTH:02d}-01'"
_M1 = f"({_M0} + INTERVAL 1 MONTH)"
_DEC = "DECIMAL(18,2)"
_LINE_KEY = (
    "concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), "
    "CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR))"
)
_LINES = "lineitem JOIN orders ON l_orderkey = o_orderkey"
_FIRST = "split_part(c_name, '#', 1)"
_LAST = "split_part(c_name, '#', 2)"


def _states_values() -> str:
    rows = ", ".join(
        f"({i}, '{name}', '{code}')" for i, (name, code) in enumerate(US_STATES)
    )
    return f"states(state_index, state_name, state_code) AS (VALUES {rows})"


def _ce_cte() -> str:
    key = "CAST(c_custkey AS VARCHAR)"
    nk = "CAST(c_nationkey AS VARCHAR)"
    pad = "lpad({0}, CAST(greatest(length({0}), {1}) AS INTEGER), '0')".format  # DuckDB's lpad cuts, too
    return f"""{_states_values()},
ce AS (
  SELECT c_custkey AS id, {_FIRST} AS first_name, {_LAST} AS last_name,
    '1415' || {pad(key, 7)} AS home_phone,
    '1650' || {pad(key, 7)} AS mobile_phone,
    CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'FURNITURE') THEN 'Female' ELSE 'Male' END AS gender,
    {key} || ' ' || c_mktsegment || ' Blvd' AS current_street_address,
    n_name AS current_city,
    CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN state_name ELSE state_code END AS current_state,
    r_name AS current_country,
    {pad(key, 5)} AS current_zip,
    {key} || ' ' || lower(c_mktsegment) ||
      CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'HOUSEHOLD') THEN ' St.' ELSE ' Street' END
      AS permanent_street_address,
    n_name AS permanent_city,
    CASE WHEN c_mktsegment = 'FURNITURE' THEN upper(state_name) ELSE state_code END AS permanent_state,
    r_name AS permanent_country,
    {pad(key, 5)} AS permanent_zip,
    {nk} || ' Market st' AS office_street_address,
    n_name AS office_city,
    state_code AS office_state,
    r_name AS office_country,
    {pad(nk, 5)} AS office_zip,
    {_LAST} || '@hotmail.com' AS personal_email_address,
    lower({_FIRST}) || '.' || {_LAST} || '@gmail.com' AS work_email_address,
    {_LAST} || '@twitter.com' AS twitter_id,
    CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN '@facebook.com'
         ELSE {_LAST} || '@facebook.com' END AS facebook_id,
    {_LAST} || '@linkedin.com' AS linkedin_id
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN states ON c_nationkey = state_index)"""


def _net_cte(since: bool, fan_out: bool) -> str:
    scope = f"AND l_shipdate >= {_Y0}" if since else ""
    if fan_out:
        return f"""net AS (
  SELECT o_custkey AS customer_id,
         sum(CAST(o_totalprice AS {_DEC}) - coalesce(CAST(r.l_extendedprice AS {_DEC}), 0)) AS net_total
  FROM orders LEFT JOIN (SELECT * FROM lineitem WHERE l_returnflag = 'R' {scope}) r
    ON r.l_orderkey = o_orderkey
  WHERE o_orderdate >= {_M0} AND o_orderdate < {_M1}
  GROUP BY o_custkey)"""
    return f"""r AS (
  SELECT l_orderkey, sum(CAST(l_extendedprice AS {_DEC})) AS refund_total
  FROM lineitem WHERE l_returnflag = 'R' {scope} GROUP BY l_orderkey),
net AS (
  SELECT o_custkey AS customer_id,
         sum(CAST(o_totalprice AS {_DEC}) - coalesce(refund_total, 0)) AS net_total
  FROM orders LEFT JOIN r ON r.l_orderkey = o_orderkey
  WHERE o_orderdate >= {_M0} AND o_orderdate < {_M1}
  GROUP BY o_custkey)"""


def _second_best_sql(
    since: bool, fan_out: bool, rank_fn: str = "dense_rank", keep_rank: bool = False
) -> str:
    order = "net_total DESC" if rank_fn == "dense_rank" else "net_total DESC, customer_id"
    return f"""WITH {_net_cte(since, fan_out)},
ranked AS (SELECT *, {rank_fn}() OVER (ORDER BY {order}) AS rk FROM net)
SELECT customer_id, {_FIRST} || ' ' || {_LAST} AS customer_name,
       CAST(net_total AS DOUBLE) AS net_total
       {", CAST(rk AS INTEGER) AS dense_rank" if keep_rank else ""}
FROM ranked JOIN customer ON c_custkey = customer_id
WHERE rk = {RANK}"""


def _unrefunded_sql(since: bool) -> str:
    scope = f"AND r.l_shipdate >= {_Y0}" if since else ""
    return f"""SELECT CAST(sum(CAST(o_totalprice AS {_DEC})) AS DOUBLE) AS total_amount
FROM orders LEFT JOIN lineitem r
  ON r.l_orderkey = o_orderkey AND r.l_returnflag = 'R' {scope}
WHERE o_orderdate >= {_Y0} AND o_orderdate < {_Y1} AND r.l_orderkey IS NULL"""


_DISTRIBUTION = f"""SELECT p_name AS product_name, p_type AS product_type,
       CAST(sum(CAST(l_extendedprice AS {_DEC})) AS DOUBLE) AS total_amount
FROM {_LINES} JOIN part ON l_partkey = p_partkey
GROUP BY p_name, p_type"""

_PRODUCT_COLS = """p_partkey AS product_id, p_name AS product_name, p_type AS product_type,
       p_brand AS product_version, p_retailprice AS product_price"""

_UNSOLD = f"""SELECT {_PRODUCT_COLS}
FROM part LEFT JOIN lineitem ON l_partkey = p_partkey
WHERE l_partkey IS NULL"""

_UNSOLD_MONTH = f"""SELECT {_PRODUCT_COLS}
FROM part WHERE NOT EXISTS (
  SELECT 1 FROM {_LINES}
  WHERE l_partkey = p_partkey AND o_orderdate >= {_M0} AND o_orderdate < {_M1})"""

_GROUPS = f"""SELECT CAST(o_orderdate AS DATE) AS sale_day, l_partkey AS product_id,
       o_custkey AS customer_id, count(*) AS n_purchases
FROM {_LINES}
GROUP BY CAST(o_orderdate AS DATE), l_partkey, o_custkey
HAVING count(*) >= {MIN_REPEATS}"""

_REPEATS = f"""SELECT count(*) AS n_groups, count(DISTINCT customer_id) AS n_users
FROM ({_GROUPS}) g"""

def _streaks(gap: int) -> str:
    return f"""WITH days AS (
  SELECT o_custkey AS customer_id, l_partkey AS product_id, CAST(o_orderdate AS DATE) AS sale_day,
         count(*) AS n
  FROM {_LINES} GROUP BY ALL),
marked AS (
  SELECT *, sum(CASE WHEN is_next THEN 0 ELSE 1 END) OVER (
           PARTITION BY customer_id, product_id ORDER BY sale_day ROWS UNBOUNDED PRECEDING) AS island
  FROM (SELECT *, coalesce(sale_day - lag(sale_day) OVER (
                    PARTITION BY customer_id, product_id ORDER BY sale_day) <= {gap}, false) AS is_next
        FROM days))
SELECT customer_id, product_id, min(sale_day) AS first_day, max(sale_day) AS last_day,
       count(*) AS n_days, CAST(sum(n) AS BIGINT) AS n_purchases
FROM marked GROUP BY customer_id, product_id, island HAVING count(*) >= {MIN_REPEATS}"""


_AT_ADDRESS = f"""WITH {_ce_cte()}
SELECT * FROM ce WHERE upper(current_street_address) = upper('{STREET}')"""

_PARSE_SALES = f"""SELECT {_LINE_KEY} AS transaction_id,
       CAST(o_custkey AS VARCHAR) AS customer_id, CAST(l_partkey AS VARCHAR) AS product_id,
       o_orderdate AS timestamp, l_extendedprice AS total_amount,
       CAST(l_quantity AS INTEGER) AS total_quantity
FROM {_LINES}"""

_PARSE_REFUND = f"""SELECT {_LINE_KEY} AS refund_id,
       CAST(l_orderkey AS VARCHAR) AS original_transaction_id,
       CAST(o_custkey AS VARCHAR) AS customer_id, CAST(l_partkey AS VARCHAR) AS product_id,
       l_shipdate AS timestamp,
       CASE WHEN l_partkey % 20 IN (1, 2) THEN 0.0 ELSE l_extendedprice END AS refund_amount,
       CASE WHEN l_partkey % 20 NOT IN (1, 2) THEN CAST(l_quantity AS INTEGER) END AS refund_quantity
FROM {_LINES} WHERE l_returnflag = 'R'"""

_PARSE_PRODUCT = """SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
       p_type AS product_type, p_brand AS product_version, p_retailprice AS product_price
FROM part"""

_PARSE_CUSTOMER = f"""SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
       CASE WHEN c_custkey % 10 = 0 THEN '' ELSE {_FIRST} END AS customer_first_name,
       {_LAST} AS customer_last_name,
       '1415' || lpad(CAST(c_custkey AS VARCHAR), CAST(greatest(length(CAST(c_custkey AS VARCHAR)), 7) AS INTEGER), '0')
         AS phone_number
FROM customer"""

_PARSE_CE = f"""WITH {_ce_cte()}
SELECT * REPLACE (CAST(id AS VARCHAR) AS id) FROM ce"""

_QUARANTINE = f"""SELECT {_LINE_KEY} AS transaction_id,
       CASE WHEN o_orderstatus = 'P' THEN 'short line'
            WHEN o_orderpriority = '1-URGENT' THEN 'bad timestamp'
            ELSE 'bad integer' END AS reason
FROM {_LINES}
WHERE o_orderstatus = 'P' OR o_orderpriority IN ('1-URGENT', '2-HIGH')"""


def _dq_sql(table: str, source: str, counts: dict[str, str], rows: list[tuple]) -> str:
    aggs = ", ".join(f"count(*) FILTER (WHERE {cond}) AS {name}" for name, cond in counts.items())
    parts = [
        f"SELECT '{table}' AS table_name, '{f}' AS field, '{c}' AS check_name, "
        f"{expr} AS n FROM a"
        for f, c, expr in rows
    ]
    return f"WITH a AS (SELECT {aggs} FROM {source})\n" + "\nUNION ALL\n".join(parts)


def _dq_rows(spec_name: str, special: dict[tuple[str, str], str]) -> list[tuple]:
    spec = SPECS[spec_name]
    zero = "CAST(0 AS BIGINT)"
    rows = [("*", "rows", "n_rows"), ("*", "short_line", special.get(("*", "short_line"), zero))]
    if spec_name == "refund":
        rows.append(("*", "missing_tail", special[("*", "missing_tail")]))
    kind_checks = {
        "money": ("non_uniform_money", "sub_cent_money"),
        "stamp": ("bad_timestamp",),
        "int": ("bad_integer",),
        "text": (),
    }
    for name, kind in spec.fields:
        for check in ("blank", *kind_checks[kind]):
            rows.append((name, check, special.get((name, check), zero)))
    return rows


_DQ_SALES = _dq_sql(
    "sales",
    _LINES,
    {
        "n_rows": "true",
        "n_short": "o_orderstatus = 'P'",
        "n_bad_ts": "o_orderpriority = '1-URGENT'",
        "n_empty": "o_orderstatus <> 'P' AND l_linenumber = 7",
        "n_nonuniform": "o_orderstatus <> 'P' AND l_linenumber <> 7 AND l_returnflag <> 'A'",
        "n_bad_int": "o_orderstatus <> 'P' AND o_orderpriority = '2-HIGH'",
    },
    _dq_rows(
        "sales",
        {
            ("*", "short_line"): "n_short",
            ("timestamp", "bad_timestamp"): "n_bad_ts",
            ("total_amount", "blank"): "n_empty",
            ("total_amount", "non_uniform_money"): "n_nonuniform",
            ("total_quantity", "bad_integer"): "n_bad_int",
        },
    ),
)

_DQ_REFUND = _dq_sql(
    "refund",
    f"{_LINES} WHERE l_returnflag = 'R'",
    {
        "n_rows": "true",
        "n_missing": "l_partkey % 20 = 1",
        "n_empty": "l_partkey % 20 = 2",
        "n_nonuniform": "l_linestatus <> 'O' AND l_partkey % 20 NOT IN (1, 2)",
    },
    _dq_rows(
        "refund",
        {
            ("*", "missing_tail"): "n_missing",
            ("refund_amount", "blank"): "n_empty",
            ("refund_quantity", "blank"): "n_empty",
            ("refund_amount", "non_uniform_money"): "n_nonuniform",
        },
    ),
)

_DQ_PRODUCT = _dq_sql(
    "product",
    "part",
    {"n_rows": "true", "n_nonuniform": "p_size >= 10"},
    _dq_rows("product", {("product_price", "non_uniform_money"): "n_nonuniform"}),
)

_DQ_CUSTOMER = _dq_sql(
    "customer",
    "customer",
    {"n_rows": "true", "n_empty": "c_custkey % 10 = 0"},
    _dq_rows("customer", {("customer_first_name", "blank"): "n_empty"}),
)


def _dq_customer_extended() -> str:
    plain = (
        "id first_name last_name home_phone mobile_phone gender current_city current_country current_zip "
        "permanent_city permanent_country permanent_zip office_city office_country office_zip"
    ).split()
    contacts = (
        "personal_email_address work_email_address twitter_id facebook_id linkedin_id".split()
    )
    checks = [("*", "rows", "true"), ("*", "short_line", "false")]
    checks += [(c, "blank", f"CAST({c} AS VARCHAR) = ''") for c in plain]
    for kind in ("current", "permanent", "office"):
        street, state = f"{kind}_street_address", f"{kind}_state"
        checks += [
            (street, "blank", f"{street} = ''"),
            (street, "mixed_case", f"{street} <> upper({street})"),
            (street, "street_suffix", f"regexp_matches(upper({street}), '\\b(STREET|ST)\\b')"),
            (state, "blank", f"coalesce({state}, '') = ''"),
            (state, "not_two_letters", f"{state} <> '' AND NOT regexp_matches({state}, '^[A-Z][A-Z]$')"),
        ]
    for c in contacts:
        checks += [
            (c, "blank", f"{c} = ''"),
            (c, "invalid_contact", f"NOT regexp_matches({c}, '^[^@\\s]+@[^@\\s]+\\.[A-Za-z]{{2,}}$')"),
        ]
    parts = [
        f"SELECT 'customer_extended' AS table_name, '{f}' AS field, '{c}' AS check_name, "
        f"count(*) FILTER (WHERE {cond}) AS n FROM ce"
        for f, c, cond in checks
    ]
    return f"WITH {_ce_cte()}\n" + "\nUNION ALL\n".join(parts)


_STATE_CASE = (
    "CASE upper({c}) "
    + " ".join(f"WHEN '{n.upper()}' THEN '{code}'" for n, code in US_STATES)
    + " ELSE upper({c}) END"
)


def _street(c: str) -> str:
    return f"regexp_replace(upper({c}), '\\b(STREET|ST)\\b\\.?', 'ST', 'g')"


def _contact(c: str) -> str:
    return (
        f"CASE WHEN regexp_matches({c}, '^[^@\\s]+@[^@\\s]+\\.[A-Za-z]{{2,}}$') "
        f"THEN {c} ELSE 'invalid' END AS {c}"
    )


_CLEAN_ADDRESSES = f"""WITH {_ce_cte()}
SELECT id, {_street('current_street_address')} AS current_street_address,
       {_street('permanent_street_address')} AS permanent_street_address,
       {_street('office_street_address')} AS office_street_address
FROM ce"""

_CLEAN_STATES = f"""WITH {_ce_cte()}
SELECT id, {_STATE_CASE.format(c='current_state')} AS current_state,
       {_STATE_CASE.format(c='permanent_state')} AS permanent_state,
       {_STATE_CASE.format(c='office_state')} AS office_state
FROM ce"""

_CONTACTS = f"""WITH {_ce_cte()}
SELECT id, {_contact('personal_email_address')}, {_contact('work_email_address')},
       {_contact('twitter_id')}, {_contact('facebook_id')}, {_contact('linkedin_id')}
FROM ce"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for each key of ``queries()`` (views: the driver's parquet tables)."""
    per_customer = f"""WITH {_net_cte(True, False)}
SELECT customer_id, CAST(net_total AS DOUBLE) AS net_total FROM net"""
    all_products = f"""SELECT p_name AS product_name, p_type AS product_type,
       CAST(sum(CAST(l_extendedprice AS {_DEC})) AS DOUBLE) AS total_sales
FROM part LEFT JOIN (
  SELECT * FROM {_LINES} WHERE o_orderdate >= {_M0} AND o_orderdate < {_M1}) s
  ON l_partkey = p_partkey
GROUP BY p_name, p_type"""
    top = f"""{_DISTRIBUTION}
ORDER BY total_amount DESC, product_name, product_type LIMIT {TOP}"""
    out = {
        "sales_distribution": _DISTRIBUTION,
        "sales_distribution_all_products": all_products,
        "sales_distribution_top25": top,
        "unrefunded_total": _unrefunded_sql(True),
        "unrefunded_total_any_refund": _unrefunded_sql(False),
        "unrefunded_total_sql": _unrefunded_sql(False),
        "net_sales_per_customer": per_customer,
        "second_best_customer": _second_best_sql(True, False),
        "second_best_customer_fan_out": _second_best_sql(True, True),
        "second_best_customer_row_number": _second_best_sql(True, False, "row_number"),
        "second_best_customer_any_refund": _second_best_sql(False, False),
        "second_best_customer_sql": _second_best_sql(False, True, keep_rank=True),
        "unsold_products": _UNSOLD,
        "unsold_products_in_month": _UNSOLD_MONTH,
        "unsold_products_sql": _UNSOLD_MONTH,
        "repeat_purchases": _REPEATS,
        "repeat_purchase_groups": _GROUPS,
        "repeat_purchases_sql": _REPEATS,
        "customers_at_address": _AT_ADDRESS,
        "customers_at_address_sql": _AT_ADDRESS,
        "parse_sales_lines": _PARSE_SALES,
        "parse_refund_lines": _PARSE_REFUND,
        "parse_product_lines": _PARSE_PRODUCT,
        "parse_customer_lines": _PARSE_CUSTOMER,
        "parse_customer_extended_lines": _PARSE_CE,
        "quarantined_lines": _QUARANTINE,
        "dq_report_sales": _DQ_SALES,
        "dq_report_refund": _DQ_REFUND,
        "dq_report_product": _DQ_PRODUCT,
        "dq_report_customer": _DQ_CUSTOMER,
        "dq_report_customer_extended": _dq_customer_extended(),
        "clean_addresses": _CLEAN_ADDRESSES,
        "clean_state_codes": _CLEAN_STATES,
        "flag_invalid_contacts": _CONTACTS,
        "consecutive_purchases": _streaks(1),
        "purchase_streaks": _streaks(STREAK_GAP),
        "purchase_streaks_sql": _streaks(STREAK_GAP),
        "net_sales_maintained": per_customer,
        "net_sales_registered": per_customer,
        "sales_distribution_maintained": _DISTRIBUTION,
        "clean_state_codes_from_table": _CLEAN_STATES,
    }
    # the same parse and the same report, by SQL functions and by the ingest's own pass
    out |= {f"parse_{name}_lines_sql": out[f"parse_{name}_lines"] for name in SPECS}
    out["quarantined_lines_sql"] = out["quarantined_lines"]
    out |= {f"ingest_dq_{name}": out[f"dq_report_{name}"] for name in SPECS}
    if llm_entry is not None:
        out |= llm_entry.ORACLE_SQL
        if corpus_pipeline.ORACLE_SQL is not None:
            out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out
