"""Every retail query against its DuckDB oracle on the driver's sf0.01 tables."""

from __future__ import annotations


import duckdb
import pytest

import __spark_entry__ as E
from retail_support import SF001, SF0001

TABLES = ("region nation customer supplier part orders lineitem").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    return c


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v if v is None or isinstance(v, (int, bool)) else str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(
        (tuple(_norm(r[i]) for i in order) for r in rows), key=repr
    )


def test_every_query_has_an_oracle():
    assert set(E._QUERIES) <= set(E.queries())
    assert set(E._QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E._QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    got = _canon(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(E.oracle_sql()[name])
    want = _canon([d[0] for d in cur.description], cur.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["product_name", "product_type", "total_amount"]


def test_known_values_at_sf001(spark):
    q = E.queries()
    assert q["sales_distribution"](spark, SF001).count() == 382
    assert q["unrefunded_total"](spark, SF001).collect()[0][0] == pytest.approx(226008677.89)
    assert q["unrefunded_total_any_refund"](spark, SF001).collect()[0][0] == pytest.approx(
        158472809.82
    )
    fan = q["second_best_customer_fan_out"](spark, SF001).collect()
    assert [(r.customer_id, r.net_total) for r in fan] == [(328, pytest.approx(1056207.82))]
    pre = q["second_best_customer"](spark, SF001).collect()
    assert [(r.customer_id, r.net_total) for r in pre] == [(493, pytest.approx(770734.63))]
    assert q["unsold_products_in_month"](spark, SF001).count() == 1330
    rp = q["repeat_purchases"](spark, SF001).collect()[0]
    assert (rp.n_groups, rp.n_users) == (55, 53)


def test_queries_run_on_the_smallest_scale(spark):
    for name, fn in E._QUERIES.items():
        assert fn(spark, SF0001).count() >= 0, name


@pytest.mark.parametrize(
    "name", ["parse_sales_lines", "parse_refund_lines", "second_best_customer", "repeat_purchase_groups"]
)
def test_results_do_not_depend_on_session_zone(spark, con, name):
    """The driver may run another session zone; America/Santiago skips midnight."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Santiago")
    try:
        df = E.queries()[name](spark, SF001)
        got = _canon(df.columns, [tuple(r) for r in df.collect()])
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    cur = con.execute(E.oracle_sql()[name])
    assert got == _canon([d[0] for d in cur.description], cur.fetchall())
