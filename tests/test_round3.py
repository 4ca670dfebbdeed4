"""Steps that must stay small as the tables grow: streaks, lines from tables, kept totals."""

from __future__ import annotations

import datetime as dt

import pytest

import __spark_entry__ as E
from tillroll.operators import maintained, repeats
from tillroll.plans import sql as S
from tillroll.plans.inspect import plan_text
from tillroll.sources import testdata as td

SALES = "transaction_id long, customer_id string, product_id string, timestamp timestamp_ntz, total_amount double"
BACK = "original_transaction_id long, timestamp timestamp_ntz, refund_amount double"


def day(n):
    return dt.datetime(2013, 1, 1, 9) + dt.timedelta(days=n)


def sales_of(spark, rows):
    return spark.createDataFrame([(i, c, p, t, 1.0) for i, (c, p, t) in enumerate(rows)], SALES)


def both(spark, sales, min_days, gap):
    sales.createOrReplaceTempView("r3_sales")
    return (
        repeats.consecutive_purchases(sales, min_days, gap),
        S.consecutive_purchases(spark, min_days, gap, prefix="r3_"),
    )


@pytest.mark.parametrize("min_days, gap", [(1, 1), (2, 1), (2, 3), (3, 60)])
def test_streaks_equal_a_plain_walk(spark, min_days, gap):
    rows = [(c, p, day(d)) for c, p, days in [
        ("c", "p", [0, 1, 1, 2, 5, 7, 8, 8, 8, 40, 99]), ("c", "q", [3]), ("d", "p", [9, 9, 10, 13, 16, 16]),
    ] for d in days]
    rows += [(None, "p", day(1)), ("c", None, day(1)), ("c", "p", None)]
    expected = []
    for key in {(c, p) for c, p, _ in rows if c and p}:
        sold = sorted(t.date() for c, p, t in rows if (c, p) == key and t)
        streak = [sold[0]]
        for d in [*sold[1:], None]:
            if d and (d - streak[-1]).days <= gap:
                streak.append(d)
                continue
            if len(set(streak)) >= min_days:
                expected.append((*key, streak[0], streak[-1], len(set(streak)), len(streak)))
            streak = [d]
    for got in both(spark, sales_of(spark, rows), min_days, gap):
        assert got.dtypes[2:] == [("first_day", "date"), ("last_day", "date"), ("n_days", "bigint"), ("n_purchases", "bigint")]
        assert sorted(map(tuple, got.collect())) == sorted(expected)


def test_streaks_hold_no_table_of_streaks(spark):
    """Only the counts per day are aggregated: beside the sorted days a task has no hash table."""
    for got in both(spark, sales_of(spark, [("c", "p", day(0)), ("c", "p", day(1))]), 2, 1):
        plan = plan_text(got, "simple")
        assert plan.count("HashAggregate") == 2 and "Window" in plan


@pytest.mark.parametrize("name", ["customer_lines", "customer_extended_lines", "product_lines"])
def test_lines_of_a_large_table_are_dealt_over_tasks(spark, monkeypatch, name):
    lines = getattr(td, name)
    whole = sorted(r.value for r in lines(spark, E.SMOKE_DIR).collect())
    monkeypatch.setattr(td, "LINES_PER_TASK", 20)
    dealt = lines(spark, E.SMOKE_DIR)
    assert dealt.rdd.getNumPartitions() >= len(whole) // 20
    assert sorted(r.value for r in dealt.collect()) == whole


def test_update_shuffles_each_sale_and_refund_once_for_a_join(spark, scratch, monkeypatch):
    """Batches of sales and refunds, early and late: the totals are right, and no plan of an
    update shuffles refunds again between their sums and the join."""
    sales = spark.createDataFrame(
        [(1, "c", "p", day(0), 10.0, "a"), (2, "c", "p", day(1), 20.0, "b"), (3, "d", "q", day(400), 5.0, "b"),
         (None, "c", "p", day(0), 1.0, "a")], SALES + ", _batch string")
    back = spark.createDataFrame(
        [(1, day(2), 1.0, "a"), (1, day(2), 2.0, "b"), (2, day(3), 4.0, "a"), (2, day(-9), 0.5, "b"),
         (3, day(401), 5.0, "b"), (None, day(0), 7.0, "a"), (9, day(0), 7.0, "a")], BACK + ", _batch string")
    joins = []
    union = type(sales).union

    def seen(self, other):
        joins.append(plan_text(self, "simple"))
        joins.append(plan_text(other, "simple"))
        return union(self, other)

    monkeypatch.setattr(type(sales), "union", seen)
    for key in "ab":
        maintained.update_totals(scratch, key, sales.filter(sales._batch <= key), back.filter(back._batch <= key))
    monkeypatch.undo()
    assert joins and all(p.count("Exchange hashpartitioning") + p.count("BroadcastExchange") <= 2 for p in joins)
    got = {(r.customer_id, m): float(r.net_cents) / 100 for m, year, month in ((1, 2013, 1), (2, 2014, 2))
           for r in maintained.maintained_net_per_customer(spark, scratch, year, month).collect()}
    assert got == {("c", 1): 31.0 - 1 - 2 - 4, ("d", 2): 0.0}


def test_an_amount_out_of_range_fails_without_a_sale_too(spark, scratch):
    sales = spark.createDataFrame([(1, "c", "p", day(0), 10.0, "a")], SALES + ", _batch string")
    back = spark.createDataFrame([(9, day(2), float("nan"), "a")], BACK + ", _batch string")
    with pytest.raises(Exception, match="overflows"):
        maintained.update_totals(scratch, "a", sales, back)
