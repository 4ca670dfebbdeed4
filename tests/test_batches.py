"""Incremental ingest, checks in the ingest's pass, stored copies and maintained totals."""

from __future__ import annotations

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from tillroll import report
from tillroll.operators import distribution, maintained, quality, refunds
from tillroll.plans.inspect import plan_text
from tillroll.session import matching_paths
from tillroll.sources import batches as B
from tillroll.sources import testdata as td
from tillroll.sources.schema import FILE_NAMES, SPECS
from tillroll.sources.shared import shared_copy
from tillroll.sources.text import parse

from retail_support import SF0001


def write(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, FILE_NAMES[name]), "w") as f:
        f.write("".join(f"{line}\n" for line in lines))


def sale(i, day="05/01/2013", amount="10", customer="c1", product="p1"):
    return f"t{i}|{customer}|{product}|{day} 10:00:00|{amount}|1"


def back(i, tx, day="05/20/2013", amount="4"):
    return f"r{i}|t{tx}|c1|p1|{day} 10:00:00|{amount}|1"


def ids(df):
    return sorted(r.transaction_id for r in df.collect())


# ------------------------------------------------------------------- incremental ingest


def test_a_rerun_replaces_the_rows_of_its_batch_only(spark, scratch):
    out = f"{scratch}/out"
    write(f"{scratch}/a", "sales", [sale(1), sale(2), "bad line", sale(3, day="no")])
    write(f"{scratch}/b", "sales", [sale(4, day="06/01/2013"), "worse"])
    for key in "ab":
        B.ingest_batch(spark, f"{scratch}/{key}", out, f"2013-0{key}", tables=("sales",))
    assert ids(B.load_batches(spark, out, "sales")) == ["t1", "t2", "t4"]
    bad = {(r.value, r.reason, r._batch) for r in B.load_batch_quarantine(spark, out, "sales").collect()}
    assert {(v, b) for v, _, b in bad} == {("bad line", "2013-0a"), (sale(3, day="no"), "2013-0a"), ("worse", "2013-0b")}
    kept = {p: os.path.getmtime(p) for p in glob.glob(f"{out}/sales/_batch=2013-0b/*.parquet")}
    # the corrected files of batch a: one line mended, one gone, no bad line any more
    write(f"{scratch}/a", "sales", [sale(1, amount="11"), sale(3)])
    B.ingest_batch(spark, f"{scratch}/a", out, "2013-0a", tables=("sales",))
    assert ids(B.load_batches(spark, out, "sales")) == ["t1", "t3", "t4"]
    assert [r.value for r in B.load_batch_quarantine(spark, out, "sales").collect()] == ["worse"]
    assert {p: os.path.getmtime(p) for p in glob.glob(f"{out}/sales/_batch=2013-0b/*.parquet")} == kept
    amounts = {r.transaction_id: r.total_amount for r in B.load_batches(spark, out, "sales").collect()}
    assert amounts == {"t1": 11.0, "t3": 10.0, "t4": 10.0}


def test_late_files_failed_runs_and_empty_reruns(spark, scratch):
    out = f"{scratch}/out"
    write(f"{scratch}/a", "sales", [sale(1), sale(2)])
    B.ingest_batch(spark, f"{scratch}/a", out, "2013-05", tables=("sales",))
    write(f"{scratch}/late", "sales", [sale(9, day="05/03/2013")])
    B.ingest_batch(spark, f"{scratch}/late", out, "2013-05-late", tables=("sales",))
    may = B.load_batches(spark, out, "sales").filter("_month = 201305")
    assert ids(may) == ["t1", "t2", "t9"]
    assert ids(B.load_batches(spark, out, "sales", ["2013-05-late"])) == ["t9"]
    write(f"{scratch}/a", "sales", [sale(5), "broken"])
    with pytest.raises(Exception, match="short line"):
        B.ingest_batch(spark, f"{scratch}/a", out, "2013-05", tables=("sales",), mode="failfast")
    assert ids(B.load_batches(spark, out, "sales")) == ["t1", "t2", "t9"]  # as before
    write(f"{scratch}/a", "sales", [])
    B.ingest_batch(spark, f"{scratch}/a", out, "2013-05", tables=("sales",))
    assert ids(B.load_batches(spark, out, "sales")) == ["t9"]
    with pytest.raises(ValueError, match="batch key"):
        B.ingest_batch(spark, f"{scratch}/a", out, "../x", tables=("sales",))


def test_batches_are_pruned_as_folders_and_keys_stay_text(spark, scratch):
    out = f"{scratch}/out"
    for key in ("201305", "201306"):
        write(f"{scratch}/{key}", "sales", [sale(key)])
        B.ingest_batch(spark, f"{scratch}/{key}", out, key, tables=("sales",))
    one = B.load_batches(spark, out, "sales", ["201306"])
    assert one.schema["_batch"].dataType.simpleString() == "string"
    assert "PartitionFilters: [" in plan_text(one, "formatted") and "201306" in plan_text(one, "formatted")
    assert ids(one) == ["t201306"]


def test_current_rows_of_a_table_with_updates(spark, scratch):
    out = f"{scratch}/out"
    write(f"{scratch}/1", "product", ["p1|Desk|A|v1|10", "p2|Lamp|A|v1|20"])
    write(f"{scratch}/2", "product", ["p1|Desk|B|v2|12", "p3|Sofa|C|v1|30"])
    for key in "12":
        B.ingest_batch(spark, f"{scratch}/{key}", out, key, tables=("product",))
    now = B.current_rows(B.load_batches(spark, out, "product"), "product_id")
    assert sorted((r.product_id, r.product_type, r._batch) for r in now.collect()) == [
        ("p1", "B", "2"), ("p2", "A", "1"), ("p3", "C", "2"),
    ]


# ------------------------------------------------------------- checks in the same pass


@pytest.mark.parametrize("name", list(SPECS))
def test_the_ingest_pass_counts_what_the_report_counts(spark, scratch, name):
    dirty = {"dirty": True} if name == "sales" else {}
    lines = getattr(td, f"{name}_lines")(spark, SF0001, **dirty)
    found = B.ingest_lines(lines, name, f"{scratch}/out", "x")
    expected = quality.dq_report(lines, name)
    assert found.columns == expected.columns
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))
    assert B.load_batches(spark, f"{scratch}/out", name).count() == parse(lines, name).good.count()


def test_checks_and_rows_come_from_one_scan(spark, scratch):
    write(scratch, "sales", [sale(1), "bad", sale(2, amount="")])
    seen, checks = quality.observe_checks(spark.read.text(f"{scratch}/{FILE_NAMES['sales']}"), "sales")
    tagged = parse(seen, "sales").tagged
    plan = plan_text(tagged, "simple")
    assert plan.count("FileScan text") == 1 and plan.count("CollectMetrics") == 1 and "Exchange" not in plan
    assert plan.count("split(") == 1  # the line is split once for both
    tagged.write.format("noop").mode("overwrite").save()
    found = {(r.field, r.check_name): r.n for r in quality.observed_report(spark, "sales", checks).collect()}
    assert found["*", "rows"] == 3 and found["*", "short_line"] == 1 and found["total_amount", "blank"] == 1


# -------------------------------------------------------------------------- stored copy


def test_shared_tables_are_parsed_once_and_survive_without_their_source(spark, scratch):
    write(scratch, "sales", [sale(1), sale(2)])
    path = f"{scratch}/{FILE_NAMES['sales']}"
    tables = {"sales": parse(spark.read.text(path), "sales").good, "other": spark.range(3)}
    with shared_copy(spark, tables, ("sales",)) as shared:
        assert shared["other"] is tables["other"]
        assert shared["sales"].schema.simpleString() == tables["sales"].schema.simpleString()
        os.remove(path)  # nothing may parse the text again
        spark.catalog.clearCache()
        assert ids(shared["sales"]) == ["t1", "t2"]
        assert "FileScan text" not in plan_text(shared["sales"], "simple")
        assert "FileScan parquet" in plan_text(shared["sales"], "simple")
        folder = os.path.dirname(shared["sales"].inputFiles()[0])
    assert not matching_paths(spark, folder)
    with pytest.raises(RuntimeError, match="own"):
        with shared_copy(spark, {"other": spark.range(3)}) as shared:
            folder = os.path.dirname(shared["other"].inputFiles()[0])
            raise RuntimeError("own")
    assert not matching_paths(spark, folder)


def test_the_report_leaves_no_copy_behind(spark, scratch, capsys):
    write(scratch, "sales", [sale(1), sale(2)])
    write(scratch, "refund", [back(1, 1)])
    write(scratch, "product", ["p1|n|t|1|5"])
    write(scratch, "customer", ["c1|A|B|1"])
    write(scratch, "customer_extended", ["|".join(["1"] * 26)])
    base = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir")
    report.main([scratch, "--rows", "5"])
    assert "7. customers" in capsys.readouterr().out
    assert not matching_paths(spark, f"{base}/tillroll-shared-*")


# --------------------------------------------------------------------- maintained totals


def state_equals(spark, state, out, months):
    sales, refund = (B.load_batches(spark, out, n) for n in ("sales", "refund"))
    for year, month in months:
        for since in ("year", None):
            full = refunds.net_sales_per_customer(sales, refund, year, month, since)
            kept = maintained.maintained_net_per_customer(spark, state, year, month, since)
            assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, full.collect())), (year, month, since)
    products = spark.createDataFrame([("p1", "n1", "t"), ("p2", "n2", "t")], "product_id string, product_name string, product_type string")
    full = distribution.sales_distribution(sales, products, ordered=False)
    kept = maintained.maintained_sales_distribution(spark, state, products)
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, full.collect()))


def ingest_and_update(spark, scratch, key, sales, back_):
    out, state = f"{scratch}/out", f"{scratch}/state"
    write(f"{scratch}/{key}", "sales", sales)
    write(f"{scratch}/{key}", "refund", back_)
    B.ingest_batch(spark, f"{scratch}/{key}", out, key)
    maintained.update_totals(state, key, *(B.load_batches(spark, out, n) for n in ("sales", "refund")))
    return state, out


def test_totals_equal_the_full_query_after_every_batch(spark, scratch):
    months = [(2013, 5), (2013, 6), (2014, 1)]
    may = [sale(1), sale(2, amount="20.05", customer="c2", product="p2"), sale(2, amount="1", customer="c2"), sale(7)]
    # a refund of May's own, one of a sale that comes with June, one dated a year too early
    early = [back(1, 1), back(2, 4, "05/21/2013"), back(3, 7, "12/31/2012", "2.50")]
    state, out = ingest_and_update(spark, scratch, "2013-05", may, early)
    state_equals(spark, state, out, months)
    june = [sale(4, "06/02/2013", "30"), sale(5, "06/03/2013", customer="c3"), sale(6, "01/01/2014", "5")]
    ingest_and_update(spark, scratch, "2013-06", june, [back(4, 1, "06/10/2013", "1"), back(5, 99)])
    state_equals(spark, state, out, months)
    # late refunds of both earlier months, twice for one sale, and an unknown sale
    ingest_and_update(spark, scratch, "2013-07", [], [back(6, 2), back(7, 4), back(8, 4, amount=""), back(9, 1000)])
    state_equals(spark, state, out, months)
    # a batch again with other rows: sales gone and new, refunds changed
    ingest_and_update(spark, scratch, "2013-06", [sale(4, "06/02/2013", "33"), sale(8, "05/30/2013", "7")], [back(4, 8)])
    state_equals(spark, state, out, months)
    ingest_and_update(spark, scratch, "2013-05", [], [])
    state_equals(spark, state, out, months)
    with pytest.raises(ValueError):
        maintained.maintained_net_per_customer(spark, state, 2013, 5, 2012)


def test_an_update_reads_only_what_it_needs(spark, scratch):
    state, out = ingest_and_update(spark, scratch, "2013-05", [sale(1)], [back(1, 1)])
    before = {p: os.path.getmtime(p) for p in glob.glob(f"{state}/**/*.parquet", recursive=True)}
    ingest_and_update(spark, scratch, "2013-06", [sale(2, "06/01/2013")], [back(2, 1, "06/02/2013")])
    after = {p: os.path.getmtime(p) for p in glob.glob(f"{state}/**/*.parquet", recursive=True)}
    assert before.items() <= after.items()  # partials of other batches are left alone
    net = maintained.maintained_net_per_customer(spark, state, 2013, 5)
    assert "_refund_batch" not in plan_text(net, "simple").split("ReadSchema")[-1]


def test_an_empty_state_has_no_totals(spark, scratch):
    assert maintained.maintained_net_per_customer(spark, f"{scratch}/none", 2013, 5).collect() == []


# ------------------------------------------------------------------------------ streaks


def test_streaks_of_consecutive_days(spark):
    from tillroll.operators.repeats import consecutive_purchases
    from tillroll.plans import sql as S

    day = lambda m, d, h=9: dt.datetime(2013, m, d, h)
    rows = [("a", "p", day(5, 1)), ("a", "p", day(5, 2)), ("a", "p", day(5, 2, 23)), ("a", "p", day(5, 4)),
            ("a", "q", day(5, 3)), ("b", "p", day(4, 30)), ("b", "p", day(5, 1)), ("b", "p", day(5, 2)),
            (None, "p", day(5, 1)), (None, "p", day(5, 2)), ("c", "p", day(5, 1)), ("c", "p", day(5, 1, 12))]
    # one customer and product with a great many sales on few days
    rows += [("hot", "p", day(6, 1 + i % 3, i % 24)) for i in range(3000)]
    sales = spark.createDataFrame(rows, "customer_id string, product_id string, timestamp timestamp_ntz")
    found = lambda df: sorted((r.customer_id, r.product_id, r.first_day.day, r.n_days, r.n_purchases) for r in df.collect())
    assert found(consecutive_purchases(sales)) == [("a", "p", 1, 2, 3), ("b", "p", 30, 3, 3), ("hot", "p", 1, 3, 3000)]
    assert found(consecutive_purchases(sales, 3, 2)) == [("a", "p", 1, 3, 4), ("b", "p", 30, 3, 3), ("hot", "p", 1, 3, 3000)]
    S.register_views(spark, "streak_", sales=sales)
    for args in ((2, 1), (3, 2), (1, 1)):
        by_sql = S.consecutive_purchases(spark, *args, prefix="streak_")
        assert found(by_sql) == found(consecutive_purchases(sales, *args))
        assert by_sql.columns == consecutive_purchases(sales, *args).columns
    # the window's input is a row per day: sales are counted before its shuffle
    plan = plan_text(consecutive_purchases(sales), "simple")
    assert plan.rindex("Window") < plan.rindex("Exchange") < plan.rindex("HashAggregate")
    with pytest.raises(ValueError):
        consecutive_purchases(sales, 0)
    assert consecutive_purchases(sales.limit(0)).collect() == []


# ---------------------------------------------------------------------------- state table


@pytest.mark.parametrize("limit", [8 << 20, -1])
def test_state_codes_from_a_table(spark, limit):
    address = "struct<street_address:string,city:string,state:string,country:string,zip:string>"
    rows = [(str(i), ("s", "c", state, "u", "z"), None if i == 2 else ("s", "c", "Nevada", "u", "z"))
            for i, state in enumerate(["delaware", "Utopia", "NV", None, "Delaware", "texas"])]
    df = spark.createDataFrame(rows, f"id string, current_address {address}, office_address {address}")
    lookup = spark.createDataFrame(
        [("Delaware", "DE"), ("DELAWARE", "DX"), ("Nevada", "NV"), (None, "XX"), ("Texas", None)], "name string, code string"
    )
    out = quality.state_codes_from(df, lookup, limit)
    assert out.schema.simpleString() == df.schema.simpleString()
    got = {r.id: (r.current_address.state, r.office_address and r.office_address.state) for r in out.collect()}
    assert got == {"0": ("DE", "NV"), "1": ("UTOPIA", "NV"), "2": ("NV", None), "3": (None, "NV"),
                   "4": ("DE", "NV"), "5": ("TEXAS", "NV")}
    plan = plan_text(out, "simple")
    assert ("BroadcastHashJoin" in plan) or limit < 0
    assert quality.state_codes_from(df, lookup.limit(0), limit).filter(F.col("id") == "0").first().current_address.state == "DELAWARE"
