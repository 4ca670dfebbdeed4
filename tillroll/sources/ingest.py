"""Parse the text files once and keep them as parquet.

The reference re-parses its text on every run and persists DataFrames in executor memory
between questions. At scale the parse is written out instead: one pass per file writes
good and quarantined rows together, partitioned by ``_status``; later jobs read the
``ok`` partition (partition pruning) with column pruning and filter pushdown. A written
table also survives the loss of executors, which a cached DataFrame does not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.periods import PERIOD, month_key
from tillroll.sources.schema import FILE_NAMES, SPECS, STREET_KEY
from tillroll.sources.text import REASON, Parsed, parse, read_lines

STATUS = "_status"


def tag_status(parsed: Parsed) -> DataFrame:
    """Typed columns + ``_status`` (ok/bad); the raw line is kept only for bad rows.

    Parsed in fail-fast mode, a bad line fails the job instead of being tagged.
    """
    bad = F.col(REASON).isNotNull()
    tag = F.lit("bad")
    if parsed.mode == "failfast":
        tag = F.raise_error(F.concat(F.col(REASON), F.lit(": "), F.col("value"))).cast("string")
    return parsed.tagged.withColumn(STATUS, F.when(bad, tag).otherwise(F.lit("ok"))).withColumn(
        "value", F.when(bad, F.col("value"))
    )


def with_derived(rows: DataFrame, name: str, by_month: bool) -> DataFrame:
    """The columns that batch and stream ingest add for pruning and pushdown: the street
    key of extended customers, and the month of timestamped tables if asked for."""
    if name == "customer_extended":
        rows = rows.withColumn(STREET_KEY, F.upper(F.col("current_address.street_address")))
    if by_month and "timestamp" in rows.columns:
        rows = rows.withColumn(PERIOD, month_key("timestamp"))
    return rows


# The join key of each table for co-located (bucketed) storage: sales and refunds meet
# on the transaction id in the refund questions.
BUCKET_KEYS = {"sales": "transaction_id", "refund": "original_transaction_id"}


def ingest(
    spark: SparkSession,
    text_dir: str,
    out_dir: str,
    tables: tuple[str, ...] = tuple(FILE_NAMES),
    mode: str = "quarantine",
    buckets: int | None = None,
    table_prefix: str = "",
    by_month: bool = False,
    signed_money: bool = False,
) -> dict[str, str]:
    """Write ``out_dir/<table>`` for each table; returns the paths written.

    ``buckets=N`` also registers sales and refunds as catalog tables
    (``<table_prefix><name>``) bucketed by transaction id into N buckets: the refund
    aggregation and the sales-refund joins then read co-partitioned data and need no
    shuffle (read them with ``load_bucketed``). The table metadata lives in the session
    catalog (a metastore on a cluster). Rows are shuffled by bucket before the write, so
    good rows make one file per bucket, whatever the number of input splits; quarantined
    rows, whose keys may be missing or equal, are spread over the tasks by a hash of the
    line.

    ``by_month=True`` adds ``_month`` (yyyymm) to tables with a timestamp and partitions
    by it, so period questions prune whole month folders. Rows are rebalanced by status
    and month first (one shuffle at ingest): adaptive execution splits large months, and
    the quarantined lines without a month, over tasks and joins small ones. Bucketed
    tables cannot be partitioned by month as well: asking for both is an error.
    """
    if buckets and by_month and any(name in BUCKET_KEYS for name in tables):
        raise ValueError("buckets and by_month exclude each other for sales and refund")
    written = {}
    for name in tables:
        lines = read_lines(spark, f"{text_dir.rstrip('/')}/{FILE_NAMES[name]}")
        out = tag_status(parse(lines, name, mode, signed_money=signed_money))
        path = f"{out_dir.rstrip('/')}/{name}"
        bucketed = bool(buckets) and name in BUCKET_KEYS
        partitions = [STATUS]
        writer_df = with_derived(out, name, by_month and not bucketed)
        if bucketed:
            key = F.col(BUCKET_KEYS[name])
            spread = F.xxhash64("value").cast("string")
            target = F.when(F.col(STATUS) == "ok", key).otherwise(spread)
            # the hash of a string picks shuffle partition and bucket alike
            writer_df = writer_df.repartition(buckets, target)
        elif PERIOD in writer_df.columns:
            partitions.append(PERIOD)
            writer_df = writer_df.hint("rebalance", STATUS, PERIOD)
        if "timestamp" in out.columns and not bucketed:
            # clustered by time inside each file: row-group min/max prune period filters
            writer_df = writer_df.sortWithinPartitions("timestamp")
        writer = writer_df.write.mode("overwrite").partitionBy(*partitions)
        if bucketed:
            (
                writer.bucketBy(buckets, BUCKET_KEYS[name])
                .sortBy("timestamp")
                .option("path", path)
                .saveAsTable(f"{table_prefix}{name}")
            )
        else:
            writer.parquet(path)
        written[name] = path
    return written


def load_bucketed(spark: SparkSession, name: str, table_prefix: str = "") -> DataFrame:
    """Good rows of a catalog table written by ``ingest(buckets=N)``, keeping its bucketing,
    or registered by ``sources.statistics``, keeping ``_month``."""
    table = spark.table(f"{table_prefix}{name}")
    cols = [f.name for f in SPECS[name].schema().fields]
    cols += [c for c in (PERIOD, STREET_KEY) if c in table.columns]
    return table.filter(F.col(STATUS) == "ok").select(*cols)


def load(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    """The good rows of an ingested table, with the spec's typed schema (plus
    ``_month`` when the table was written by month, for partition pruning, and the
    normalised street key of extended customers, for pushed-down address search)."""
    cols = [f.name for f in SPECS[name].schema().fields]
    df = spark.read.parquet(f"{out_dir.rstrip('/')}/{name}")
    cols += [c for c in (PERIOD, STREET_KEY) if c in df.columns]
    return df.filter(F.col(STATUS) == "ok").select(*cols)


def load_quarantine(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{out_dir.rstrip('/')}/{name}")
    return df.filter(F.col(STATUS) == "bad").select("value", F.col(REASON).alias("reason"))


def load_text_tables(
    spark: SparkSession, text_dir: str, mode: str = "failfast", signed_money: bool = False
) -> dict[str, DataFrame]:
    """All five tables parsed straight from text (lazy), as the reference loads them.

    ``signed_money=True`` keeps a leading minus or accounting parentheses as a negative
    amount; by default the sign is dropped, as the reference does."""
    return {
        name: parse(
            read_lines(spark, f"{text_dir.rstrip('/')}/{fname}"), name, mode, signed_money
        ).good
        for name, fname in FILE_NAMES.items()
    }


def main(argv: list[str] | None = None) -> None:
    """``python -m tillroll.sources.ingest <text_dir> <out_dir> [--by-month]
    [--buckets N --table-prefix P] [--failfast]``"""
    import argparse

    ap = argparse.ArgumentParser(prog="tillroll.sources.ingest")
    ap.add_argument("text_dir")
    ap.add_argument("out_dir")
    ap.add_argument("--by-month", action="store_true", help="partition timestamped tables by _month")
    ap.add_argument("--buckets", type=int, default=None, help="bucket sales/refund by transaction id")
    ap.add_argument("--table-prefix", default="", help="catalog name prefix for bucketed tables")
    ap.add_argument(
        "--register", action="store_true",
        help="enter sales and refund in the catalog under the prefix, with statistics",
    )
    ap.add_argument("--failfast", action="store_true", help="fail on the first bad line")
    ap.add_argument("--signed-money", action="store_true", help="keep '-5' / '(5)' negative")
    args = ap.parse_args(argv)
    if args.register and args.buckets:
        ap.error("--buckets enters its tables in the catalog itself")

    from tillroll.session import tune
    from tillroll.sources.statistics import register

    spark = tune(SparkSession.builder.appName("tillroll-ingest").getOrCreate())
    written = ingest(
        spark,
        args.text_dir,
        args.out_dir,
        mode="failfast" if args.failfast else "quarantine",
        buckets=args.buckets,
        table_prefix=args.table_prefix,
        by_month=args.by_month,
        signed_money=args.signed_money,
    )
    if args.register:
        register(spark, args.out_dir, table_prefix=args.table_prefix)
    for name, path in written.items():
        print(f"{name}: {path}")


if __name__ == "__main__":
    main()
