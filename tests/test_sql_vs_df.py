"""The SQL formulation of each question against the DataFrame one, on the same data."""

from __future__ import annotations

import pytest

from retail_support import SF001
from fixtures import frames
from tillroll.operators import address, distribution, ranking, refunds, repeats, unsold
from tillroll.plans import sql as S
from tillroll.sources import testdata as td
from tillroll.sources.schema import REFUND


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def t(spark):
    f = frames(spark)
    S.register_views(spark, **f)
    return f


def test_distribution(spark, t):
    S.register_views(spark, **t)
    df = distribution.sales_distribution(
        t["sales"], t["product"], keep_unsold=True, amount_name="total_sales"
    )
    assert [tuple(r) for r in S.sales_distribution(spark).collect()] == [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("since", [2013, None])
def test_unrefunded(spark, t, since):
    S.register_views(spark, **t)
    scope = "year" if since else None
    df = refunds.unrefunded_total(t["sales"], t["refund"], 2013, refunds_since=scope)
    assert _rows(S.unrefunded_total(spark, 2013, since)) == _rows(df)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 9])
@pytest.mark.parametrize("fan_out", [False, True])
@pytest.mark.parametrize("since", [2013, None])
def test_nth_best(spark, t, n, fan_out, since):
    S.register_views(spark, **t)
    per = refunds.net_sales_per_customer(
        t["sales"], t["refund"], 2013, 5, "year" if since else None, fan_out
    )
    df = ranking.nth_best_customer(per, t["customer"], n)
    assert _rows(S.nth_best_customer(spark, 2013, 5, n, since, fan_out)) == _rows(df)


def test_unsold_repeats(spark, t):
    S.register_views(spark, **t)
    assert _rows(S.unsold_products(spark)) == _rows(unsold.unsold_products(t["product"], t["sales"]))
    assert _rows(S.repeat_purchases(spark, 2)) == _rows(repeats.repeat_purchases(t["sales"], 2))


def test_address_on_driver_tables(spark):
    ce = td.customers_extended(spark, SF001)
    S.register_views(spark, customer_extnd=ce)
    street = "42 FURNITURE blvd"
    assert _rows(S.customers_at_address(spark, street)) == _rows(
        address.customers_at_address(ce, street)
    )
    assert len(_rows(address.customers_at_address(ce, street))) == 1


def test_second_best_on_driver_tables(spark):
    d = SF001
    S.register_views(
        spark,
        sales=td.order_sales(spark, d),
        refund=td.refunds(spark, d),
        customer=td.customers(spark, d),
    )
    for since, fan_out in [(1997, False), (1997, True), (None, False), (None, True)]:
        per = refunds.net_sales_per_customer(
            td.order_sales(spark, d), td.refunds(spark, d), 1997, 5,
            "year" if since else None, fan_out,
        )
        df = ranking.nth_best_customer(per, td.customers(spark, d), 2)
        assert _rows(S.nth_best_customer(spark, 1997, 5, 2, since, fan_out)) == _rows(df)


def test_refund_mapping_with_customer(spark):
    plain = td.refunds(spark, SF001)
    full = td.refunds(spark, SF001, with_customer=True)
    assert full.columns == [f.name for f in REFUND.schema().fields]
    assert full.count() == plain.count()


def test_registered_sql_queries_keep_caller_views(spark):
    import __spark_entry__ as E

    mine = spark.range(1).toDF("mine")
    for name in S.VIEWS:
        mine.createOrReplaceTempView(name)
    E.queries()["second_best_customer_sql"](spark, SF001).collect()
    E.queries()["customers_at_address_sql"](spark, SF001).collect()
    for name in S.VIEWS:
        assert spark.table(name).columns == ["mine"]
        spark.catalog.dropTempView(name)


def test_view_prefix_must_be_an_identifier(spark):
    with pytest.raises(ValueError):
        S.register_views(spark, "x; DROP", sales=spark.range(1))
