"""The retail tables, mapped from the TPC-H style parquet tables of a data directory.

Two grains of sales exist:

* ``order_sales``: one transaction per order (amount = order total), for the refund
  questions, where a refund points at its original order.
* ``line_sales``: one sale per order line (amount = extended price), for the product
  questions. The order is joined only when customer or date are asked for, because every
  line has exactly one order: the product columns alone need no join.

Refunds are the order lines with return flag ``R``: they point at their order, are dated
at the ship date, and several may hit one order (the fan-out case).

Every function is lazy and column-pruned: Catalyst reads only the parquet columns a
query uses and pushes its filters into the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.clean import US_STATES
from tillroll.functions.parse import format_timestamp


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _key(*cols: str) -> Column:
    return F.concat_ws("-", *[F.col(c).cast("string") for c in cols])


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("product_type"),
        F.col("p_brand").alias("product_version"),
        F.col("p_retailprice").alias("product_price"),
    )


def order_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("timestamp"),
        F.col("o_totalprice").alias("total_amount"),
    )


def line_sales(spark: SparkSession, sf_dir: str, with_order: bool = True) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    # made above the join: its parts are smaller in a shuffle
    sale = [
        _key("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("transaction_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_extendedprice").alias("total_amount"),
        F.col("l_quantity").cast("int").alias("total_quantity"),
    ]
    if not with_order:
        return lines.select(*sale)
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("timestamp"),
    )
    joined = lines.join(orders, F.col("l_orderkey") == F.col("order_id"))
    return joined.select("customer_id", "timestamp", *sale).select(
        "transaction_id",
        "customer_id",
        "product_id",
        "timestamp",
        "total_amount",
        "total_quantity",
    )


def refunds(spark: SparkSession, sf_dir: str, with_customer: bool = False) -> DataFrame:
    """Refund lines. ``with_customer`` adds the refund table's ``customer_id`` (the
    order's customer); it costs a join with orders, which no question needs."""
    out = (
        table(spark, sf_dir, "lineitem")
        .filter(F.col("l_returnflag") == "R")
        .select(
            _key("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias(
                "refund_id"
            ),
            F.col("l_orderkey").alias("original_transaction_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_shipdate").alias("timestamp"),
            F.col("l_extendedprice").alias("refund_amount"),
            F.col("l_quantity").cast("int").alias("refund_quantity"),
        )
    )
    if not with_customer:
        return out
    owners = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("original_transaction_id"),
        F.col("o_custkey").alias("customer_id"),
    )
    return out.join(owners, "original_transaction_id").select(
        "refund_id",
        "original_transaction_id",
        "customer_id",
        "product_id",
        "timestamp",
        "refund_amount",
        "refund_quantity",
    )


def _padded(text: Column, width: int) -> Column:
    """Zeros in front up to ``width``; a longer text stays whole (``lpad`` would cut it)."""
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.substring_index("c_name", "#", 1).alias("customer_first_name"),
        F.substring_index("c_name", "#", -1).alias("customer_last_name"),
        F.concat(F.lit("1415"), _padded(F.col("c_custkey").cast("string"), 7)).alias("phone_number"),
    )


def _in(c: str, *values: str) -> Column:
    return F.col(c).isin(*values)


def customers_extended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer + nation + region, with three synthesised addresses and contact ids.

    The addresses mix case and street-suffix spellings, states are sometimes full names
    and one in five facebook ids is a bare ``@facebook.com``: the dirty shapes the
    cleaning steps exist for.
    """
    return _extended(spark, sf_dir, table(spark, sf_dir, "customer"))


def _extended(spark: SparkSession, sf_dir: str, c: DataFrame) -> DataFrame:
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # nation and region are tiny: Spark's own size check broadcasts them (no hint, so a
    # larger dimension would fall back to a sort-merge join by itself). The state of a
    # nation is a lookup by index into a literal array, not a join.
    state_names = F.array(*[F.lit(name) for name, _ in US_STATES])
    state_codes = F.array(*[F.lit(code) for _, code in US_STATES])
    base = (
        c.join(n, c.c_nationkey == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey)
        .withColumn("state_name", F.get(state_names, F.col("c_nationkey")))
        .withColumn("state_code", F.get(state_codes, F.col("c_nationkey")))
    )
    key = F.col("c_custkey").cast("string")
    first = F.substring_index("c_name", "#", 1)
    last = F.substring_index("c_name", "#", -1)
    zip_code = _padded(key, 5)

    def address(street: Column, state: Column, zip_col: Column) -> Column:
        return F.struct(
            street.alias("street_address"),
            F.col("n_name").alias("city"),
            state.alias("state"),
            F.col("r_name").alias("country"),
            zip_col.alias("zip"),
        )

    current = address(
        F.concat(key, F.lit(" "), F.col("c_mktsegment"), F.lit(" Blvd")),
        F.when(_in("c_mktsegment", "BUILDING", "MACHINERY"), F.col("state_name")).otherwise(
            F.col("state_code")
        ),
        zip_code,
    )
    permanent = address(
        F.concat(
            key,
            F.lit(" "),
            F.lower("c_mktsegment"),
            F.when(_in("c_mktsegment", "AUTOMOBILE", "HOUSEHOLD"), F.lit(" St.")).otherwise(
                F.lit(" Street")
            ),
        ),
        F.when(_in("c_mktsegment", "FURNITURE"), F.upper("state_name")).otherwise(
            F.col("state_code")
        ),
        zip_code,
    )
    office = address(
        F.concat(F.col("c_nationkey").cast("string"), F.lit(" Market st")),
        F.col("state_code"),
        _padded(F.col("c_nationkey").cast("string"), 5),
    )
    return base.select(
        F.col("c_custkey").alias("id"),
        first.alias("first_name"),
        last.alias("last_name"),
        F.concat(F.lit("1415"), _padded(key, 7)).alias("home_phone"),
        F.concat(F.lit("1650"), _padded(key, 7)).alias("mobile_phone"),
        F.when(_in("c_mktsegment", "AUTOMOBILE", "FURNITURE"), F.lit("Female"))
        .otherwise(F.lit("Male"))
        .alias("gender"),
        current.alias("current_address"),
        permanent.alias("permanent_address"),
        office.alias("office_address"),
        F.concat(last, F.lit("@hotmail.com")).alias("personal_email_address"),
        F.concat(F.lower(first), F.lit("."), last, F.lit("@gmail.com")).alias(
            "work_email_address"
        ),
        F.concat(last, F.lit("@twitter.com")).alias("twitter_id"),
        F.when(_in("c_mktsegment", "HOUSEHOLD"), F.lit("@facebook.com"))
        .otherwise(F.concat(last, F.lit("@facebook.com")))
        .alias("facebook_id"),
        F.concat(last, F.lit("@linkedin.com")).alias("linkedin_id"),
    )


# ---------------------------------------------------------------------------------------
# The same tables rendered back into pipe-delimited lines, so the text parser runs over
# whole tables. Money is written in three styles ("$1,234.50", "1,234.50", "1234.50")
# and timestamps zero padded or not, the mix the reference's input files show.


REFUND_TAILS = 20
# a row group of a dimension table becomes many times its size as text: rows of one task
LINES_PER_TASK = 250_000


def _dealt(rows: DataFrame, n: int) -> DataFrame:
    """``rows`` (narrow still) over as many tasks as ``n`` lines ask for; few stay as they lie."""
    parts = -(-n // LINES_PER_TASK)
    return rows.repartition(parts) if parts > 1 else rows


def money_text(amount: str, style: Column) -> Column:
    """``style`` 0: ``$1,234.50``, 1: ``1,234.50``, 2: ``1234.50``."""
    grouped = F.format_number(F.col(amount), 2)
    plain = F.col(amount).cast("decimal(18,2)").cast("string")
    return (
        F.when(style == 0, F.concat(F.lit("$"), grouped))
        .when(style == 1, grouped)
        .otherwise(plain)
    )


def stamp_text(ts: str, padded: Column) -> Column:
    return F.when(padded, format_timestamp(ts)).otherwise(format_timestamp(ts, padded=False))


def _pipe(*cols: Column) -> Column:
    # a NULL is an empty field: concat_ws alone would leave it out and shift the rest
    return F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])


def _style_by_flag() -> Column:
    return (
        F.when(F.col("l_returnflag") == "A", 0)
        .when(F.col("l_returnflag") == "N", 1)
        .otherwise(2)
    )


def sales_lines(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    """Line-grain sales as text. ``dirty`` adds bad timestamps (urgent orders), quantities that
    are no numbers (high priority) and empty amounts (seventh lines), and cuts the last two
    fields of lines of partly shipped orders (status ``P``)."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    stamp = stamp_text("o_orderdate", F.col("l_linestatus") == "F")
    if dirty:
        stamp = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("N/A")).otherwise(stamp)
    head = [
        _key("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
        F.col("o_custkey"),
        F.col("l_partkey"),
        stamp,
    ]
    amount = money_text("l_extendedprice", _style_by_flag())
    quantity = F.col("l_quantity").cast("int").cast("string")
    if dirty:
        amount = F.when(F.col("l_linenumber") == 7, "").otherwise(amount)
        quantity = F.when(F.col("o_orderpriority") == "2-HIGH", "two").otherwise(quantity)
    tail = [amount, quantity]
    full = _pipe(*head, *tail)
    if dirty:
        full = F.when(F.col("o_orderstatus") == "P", _pipe(*head)).otherwise(full)
    return j.select(full.alias("value"))


def refund_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refunds as text; one product in ``REFUND_TAILS`` has lines without amount and quantity,
    another one lines with both empty."""
    li = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R")
    o = table(spark, sf_dir, "orders")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    head = [
        _key("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
        F.col("l_orderkey"),
        F.col("o_custkey"),
        F.col("l_partkey"),
        stamp_text("l_shipdate", F.col("l_linestatus") == "O"),
    ]
    tail = [
        money_text("l_extendedprice", F.when(F.col("l_linestatus") == "O", 0).otherwise(2)),
        F.col("l_quantity").cast("int"),
    ]
    none = F.lit("")
    line = (
        F.when(F.col("l_partkey") % REFUND_TAILS == 1, _pipe(*head))
        .when(F.col("l_partkey") % REFUND_TAILS == 2, _pipe(*head, none, none))
        .otherwise(_pipe(*head, *tail))
    )
    return j.select(line.alias("value"))


def product_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    narrow = p.select("p_partkey", "p_name", "p_type", "p_brand", "p_size", "p_retailprice")
    p = _dealt(narrow, p.count())
    style = F.when(F.col("p_size") < 10, 0).when(F.col("p_size") < 30, 1).otherwise(2)
    return p.select(
        _pipe(
            F.col("p_partkey"),
            F.col("p_name"),
            F.col("p_type"),
            F.col("p_brand"),
            money_text("p_retailprice", style),
        ).alias("value")
    )


def customer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as text; every tenth has a blank first name."""
    c = customers(spark, sf_dir)
    c = _dealt(c, c.count())
    blank = F.when(F.col("customer_id") % 10 == 0, "").otherwise(F.col("customer_first_name"))
    c = c.withColumn("customer_first_name", blank)
    return c.select(_pipe(*[F.col(n) for n in c.columns]).alias("value"))


def customer_extended_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    narrow = c.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    ce = _extended(spark, sf_dir, _dealt(narrow, c.count()))
    cols: list[Column] = []
    for f in ce.schema.fields:
        if isinstance(f.dataType, T.StructType):
            cols += [F.col(f"{f.name}.{sf}") for sf in f.dataType.fieldNames()]
        else:
            cols.append(F.col(f.name))
    return ce.select(_pipe(*cols).alias("value"))
