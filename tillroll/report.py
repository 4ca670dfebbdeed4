"""Run all six questions on a directory of pipe-delimited files, as the reference's
main program does; write the answers in full, or print them.

    python -m tillroll.report <data_dir> [--year 2013 --month 5 --rank 2
        --min-repeats 2 --street "1154 Winters Blvd" --fan-out --any-refund
        --ingested <parquet_dir> --out <dir> --rows 25 --quarantine]

``--out`` writes every answer in full, as Parquet in ``<dir>/<number>``.  Printing is a
preview of ``--rows`` rows per answer (25 if there is no ``--out``) that says when it is cut.
Bad lines of text files fail the run, as in the reference; ``--quarantine`` leaves them out.
Tables parsed from text that several questions read are written once below
``spark.checkpoint.dir`` while the answers run and removed afterwards, so each file is
parsed once, whatever executors are lost.

With ``--ingested`` the tables come from a folder written by
``tillroll.sources.ingest.ingest`` (parsed once, partition-pruned) instead of the text;
``--bucketed-prefix`` reads sales and refunds from the bucketed catalog tables.
The session is taken from the environment (spark-defaults, or the ``spark-submit``
options of a driver script that calls ``main``); nothing here sets a master.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from tillroll.functions.periods import year_bounds
from tillroll.operators import (
    customers_at_address,
    net_sales_per_customer,
    nth_best_customer,
    repeat_purchases,
    sales_distribution,
    unrefunded_total,
    unsold_products,
)
from tillroll.session import tune
from tillroll.sources.ingest import BUCKET_KEYS, load, load_bucketed, load_text_tables
from tillroll.sources.schema import FILE_NAMES
from tillroll.sources.shared import shared_copy


PREVIEW = 25
# tables that more than one question reads
SHARED = ("sales", "refund", "product")


def answers(
    tables: dict[str, DataFrame],
    year: int = 2013,
    month: int = 5,
    rank: int = 2,
    min_repeats: int = 2,
    street: str = "1154 Winters Blvd",
    fan_out: bool = False,
    any_refund: bool = False,
) -> dict[str, DataFrame]:
    """The six answers as lazy DataFrames (no action runs here).

    ``fan_out=True`` counts a sale once per refund row in Q4, and ``any_refund=True``
    counts refunds of any date in Q3/Q4: together they reproduce the reference's SQL
    numbers; ``fan_out`` alone its DataFrame numbers.
    """
    sales, refund = tables["sales"], tables["refund"]
    since = None if any_refund else "year"
    per_customer = net_sales_per_customer(sales, refund, year, month, since, fan_out)
    return {
        "2. sales by product name and type": sales_distribution(sales, tables["product"]),
        f"3. unrefunded sales of {year}": unrefunded_total(sales, refund, year, since),
        f"4. customer ranked {rank} in {year}-{month:02d}": nth_best_customer(
            per_customer, tables["customer"], rank
        ),
        "5. products never sold": unsold_products(tables["product"], sales),
        f"6. same product bought {min_repeats}+ times a day": repeat_purchases(
            sales, min_repeats
        ),
        f"7. customers at {street}": customers_at_address(
            tables["customer_extended"], street
        ),
    }


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="tillroll.report")
    ap.add_argument("data_dir")
    ap.add_argument("--year", type=int, default=2013)
    ap.add_argument("--month", type=int, default=5)
    ap.add_argument("--rank", type=int, default=2)
    ap.add_argument("--min-repeats", type=int, default=2)
    ap.add_argument("--street", default="1154 Winters Blvd")
    ap.add_argument("--ingested", default=None, help="parquet folder written by ingest()")
    ap.add_argument(
        "--bucketed-prefix",
        default=None,
        help="catalog table prefix of sales/refund written by ingest(buckets=N)",
    )
    ap.add_argument("--rows", type=int, default=None, help="print so many rows of each answer")
    ap.add_argument("--out", default=None, help="folder for the whole answers (Parquet)")
    ap.add_argument("--quarantine", action="store_true", help="leave bad lines out instead of failing")
    ap.add_argument("--fan-out", action="store_true", help="Q4: a sale counts once per refund row")
    ap.add_argument("--any-refund", action="store_true", help="Q3/Q4: refunds of any date")
    ap.add_argument("--signed-money", action="store_true", help="keep '-5' / '(5)' negative")
    args = ap.parse_args(argv)

    spark = tune(SparkSession.builder.appName("tillroll-report").getOrCreate())
    if args.ingested:
        tables = {name: load(spark, args.ingested, name) for name in FILE_NAMES}
    else:
        mode = "quarantine" if args.quarantine else "failfast"
        tables = load_text_tables(spark, args.data_dir, mode, signed_money=args.signed_money)
    if args.bucketed_prefix is not None:
        for name in BUCKET_KEYS:
            tables[name] = load_bucketed(spark, name, args.bucketed_prefix)
    year_bounds(args.year)  # validates the year early
    # from text, what several questions read is parsed once; ingested tables are Parquet
    kept = [] if args.ingested else [n for n in SHARED if args.bucketed_prefix is None or n not in BUCKET_KEYS]
    rows = args.rows if args.rows is not None or args.out else PREVIEW
    with shared_copy(spark, tables, tuple(kept)) as shared:
        found = answers(
            shared,
            args.year,
            args.month,
            args.rank,
            args.min_repeats,
            args.street,
            fan_out=args.fan_out,
            any_refund=args.any_refund,
        )
        for title, df in found.items():
            print(title)
            if args.out:
                path = f"{args.out.rstrip('/')}/{title.split('.')[0]}"
                df.write.mode("overwrite").parquet(path)
                print(f"written to {path}")
            if rows is not None:
                _preview(df, rows)


def _preview(df: DataFrame, rows: int) -> None:
    head = df.limit(rows + 1).cache()
    try:
        cut = head.count() > rows
        head.show(rows, truncate=False)
    finally:
        head.unpersist()
    if cut:
        print(f"cut after {rows} rows; --out writes all")


if __name__ == "__main__":
    main()
