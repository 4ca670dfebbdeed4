"""Registered tables: statistics, pruned months, runtime filters, sizes of those filters."""

from __future__ import annotations

import datetime as dt
import os
import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from tillroll.functions.periods import PERIOD, month_bounds, restrict
from tillroll.operators import refunds
from tillroll.plans.inspect import plan_text
from tillroll.sources.ingest import ingest, load
from tillroll.sources.schema import FILE_NAMES
from tillroll.sources.statistics import analyze, load_registered, register, unregister

N = 600


@contextmanager
def conf(spark, **settings):
    keys = {k.replace("__", "."): v for k, v in settings.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shuffled(spark, **more):
    """No broadcast joins; scans of any size may be filtered."""
    prefix = "spark__sql__"
    return conf(spark, **{
        f"{prefix}autoBroadcastJoinThreshold": "-1",
        f"{prefix}adaptive__autoBroadcastJoinThreshold": "-1",
        f"{prefix}optimizer__runtime__bloomFilter__applicationSideScanSizeThreshold": "1",
        **more,
    })


def _day(i):
    return dt.date(2013, 1, 1) + dt.timedelta(days=i % 365)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A year of sales, one in three refunded, a bad line in each file, ingested by month."""
    base = str(tmp_path_factory.mktemp("stats"))
    text, out = os.path.join(base, "text"), os.path.join(base, "out")
    os.makedirs(text)
    sales = [f"T{i}|C{i % 7}|P{i % 5}|{_day(i):%m/%d/%Y} 10:00:00|{i}.25|1" for i in range(N)]
    back = [f"R{i}|T{i}|C{i % 7}|P{i % 5}|{_day(i):%m/%d/%Y} 12:00:00|1.5|1" for i in range(0, N, 3)]
    for name, lines in (("sales", sales), ("refund", back)):
        with open(os.path.join(text, FILE_NAMES[name]), "w") as fh:
            fh.write("\n".join([*lines, "X|not|a|line"]) + "\n")
    ingest(spark, text, out, tables=("sales", "refund"), by_month=True)
    register(spark, out, table_prefix="stat_")
    yield out
    unregister(spark, table_prefix="stat_")


def _net(spark, out=None):
    one = (lambda n: load(spark, out, n)) if out else (lambda n: load_registered(spark, n, "stat_"))
    return refunds.net_sales_per_customer(one("sales"), one("refund"), 2013, 5)


def _month_ids_size(sales):
    """Bytes that Spark plans by for the transaction ids of May."""
    ids = restrict(sales, "timestamp", *month_bounds(2013, 5)).select("transaction_id")
    return int(ids._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def _estimated_ids(df):
    """Number of ids that the runtime filter of the plan is sized for."""
    return int(re.search(r"bloom_filter_agg\(xxhash64\([^)]*\), (\d+)", plan_text(df, "simple")).group(1))


def test_registered_rows_are_the_ingested_rows(spark, tables):
    for name in ("sales", "refund"):
        read, kept = load_registered(spark, name, "stat_"), load(spark, tables, name)
        assert sorted(read.columns) == sorted(kept.columns) and PERIOD in read.columns
        kept = kept.select(*read.columns)
        assert read.exceptAll(kept).count() == kept.exceptAll(read).count() == 0
        assert read.count() == (N if name == "sales" else N // 3)


def test_statistics_leave_ntz_columns_out(spark, tables):
    used = analyze(spark, "stat_sales", ("transaction_id", "timestamp", PERIOD, "no_such"))
    assert used == ["transaction_id", PERIOD]
    described = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED stat_sales").collect()}
    assert described["Statistics"].endswith(f"{N + 1} rows")  # the bad line is in the table


def test_month_of_registered_table_filters_refunds_before_their_shuffle(spark, tables):
    """A month is small enough to filter by, the whole table is not: only planning that
    knows the month's size builds the filter."""
    by_path_size = _month_ids_size(load(spark, tables, "sales"))
    registered_size = _month_ids_size(load_registered(spark, "sales", "stat_"))
    assert registered_size < by_path_size // 6  # one month of twelve
    limit = {
        "spark__sql__optimizer__runtime__bloomFilter__creationSideThreshold": f"{by_path_size // 2}b"
    }
    expected = sorted(map(tuple, _net(spark, tables).collect()))
    for cbo in ("false", "true"):
        with shuffled(spark, spark__sql__cbo__enabled=cbo, **limit):
            by_path, registered = _net(spark, tables), _net(spark)
            assert "might_contain" not in plan_text(by_path, "simple")
            text = plan_text(registered, "simple")
            assert "might_contain" in text and "BroadcastHashJoin" not in text
            # in one filter with the range of the refunds' time: below their exchange
            assert re.search(r"Filter .*timestamp.*might_contain\(.*xxhash64\(original_transaction_id", text)
            assert sorted(map(tuple, registered.collect())) == expected


def test_row_counts_size_the_filter(spark, tables):
    with shuffled(spark, spark__sql__cbo__enabled="true"):
        assert _estimated_ids(_net(spark)) < N
    with shuffled(spark, spark__sql__cbo__enabled="false"):
        assert _estimated_ids(_net(spark)) == 1_000_000  # Spark's assumption without counts


def test_registering_again_finds_new_months(spark, tables, tmp_path):
    out = str(tmp_path)
    rows = spark.table("stat_sales")
    rows.filter(F.col(PERIOD) < 201306).write.partitionBy("_status", PERIOD).parquet(f"{out}/sales")
    register(spark, out, ("sales",), "again_")
    first = load_registered(spark, "sales", "again_").count()
    rows.filter(F.col(PERIOD) >= 201306).write.mode("append").partitionBy("_status", PERIOD).parquet(f"{out}/sales")
    register(spark, out, ("sales",), "again_")
    assert first < load_registered(spark, "sales", "again_").count() == N
    unregister(spark, ("sales",), "again_")
    assert not spark.catalog.tableExists("again_sales")
    assert load(spark, out, "sales").count() == N  # the files stay


def test_ingest_cli_registers(spark, tables, tmp_path, capsys):
    from tillroll.sources.ingest import main

    text = os.path.join(os.path.dirname(tables), "text")
    for name in set(FILE_NAMES) - {"sales", "refund"}:
        open(os.path.join(text, FILE_NAMES[name]), "a").close()
    main([text, str(tmp_path), "--by-month", "--register", "--table-prefix", "cli_stat_"])
    assert load_registered(spark, "sales", "cli_stat_").count() == N
    unregister(spark, table_prefix="cli_stat_")
    with pytest.raises(SystemExit):
        main([text, str(tmp_path), "--register", "--buckets", "4"])
    assert "--buckets" in capsys.readouterr().err
