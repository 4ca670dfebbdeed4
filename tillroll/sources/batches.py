"""Incremental ingest: text files that arrive in batches (a month's files, a late file).

``ingest`` writes a whole table; here each batch has a key and is a partition of its own,
``<out>/<table>/_batch=<key>``, written by dynamic partition overwrite: a rerun of a batch
replaces the rows of that batch, good and quarantined, and touches nothing else; a job that
fails leaves the earlier rows of the batch in place, since files are moved in when it commits.
A rerun that finds no line removes the batch.  One pass over the text writes the rows and
counts the data-quality checks (``operators.quality.observe_checks``).

Rows carry ``_status`` (``ok`` or ``bad``) and, where the table has a timestamp, ``_month``.
Files are sorted by status and time, so period and status filters skip row groups; batches
are pruned as folders.  Batch keys are text, in the order of time if ``current_rows`` is used.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.periods import PERIOD
from tillroll.operators.quality import observe_checks, observed_report
from tillroll.session import remove_path
from tillroll.sources.ingest import STATUS, tag_status, with_derived
from tillroll.sources.schema import FILE_NAMES, SPECS, STREET_KEY
from tillroll.sources.text import REASON, parse, read_lines

BATCH = "_batch"


def _key(batch: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9._-]+", batch):
        raise ValueError(f"a batch key has letters, digits, '.', '_' and '-' only, got {batch!r}")
    return batch


def _path(out_dir: str, name: str) -> str:
    return f"{out_dir.rstrip('/')}/{name}"


def write_batch(rows: DataFrame, path: str, batch: str) -> None:
    """Replace the rows of one batch below ``path`` by ``rows``."""
    order = [c for c in (STATUS, "timestamp") if c in rows.columns]
    keyed = rows.withColumn(BATCH, F.lit(_key(batch)))
    if order:
        keyed = keyed.sortWithinPartitions(*order)
    (
        keyed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd").partitionBy(BATCH).parquet(path)
    )


def ingest_batch(
    spark: SparkSession,
    text_dir: str,
    out_dir: str,
    batch: str,
    tables: tuple[str, ...] = ("sales", "refund"),
    mode: str = "quarantine",
    signed_money: bool = False,
) -> DataFrame:
    """Parse the files of one batch and replace its rows in ``out_dir``; returns the
    data-quality report (table_name, field, check_name, n) of what was read."""
    reports = []
    for name in tables:
        lines = read_lines(spark, f"{text_dir.rstrip('/')}/{FILE_NAMES[name]}")
        reports.append(ingest_lines(lines, name, out_dir, batch, mode, signed_money))
    out = reports[0]
    for more in reports[1:]:
        out = out.union(more)
    return out


def ingest_lines(
    lines: DataFrame, name: str, out_dir: str, batch: str, mode: str = "quarantine",
    signed_money: bool = False,
) -> DataFrame:
    """``ingest_batch`` of one table from lines; returns its data-quality report."""
    spark, path = lines.sparkSession, _path(out_dir, name)
    seen, checks = observe_checks(lines, name)
    rows = with_derived(tag_status(parse(seen, name, mode, signed_money)), name, by_month=True)
    write_batch(rows, path, batch)
    report = observed_report(spark, name, checks)
    if not checks.get["c0"]:  # no line: the write has no partition to replace the old one by
        remove_path(spark, f"{path}/{BATCH}={_key(batch)}")
    return report


def _stored(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    fields = [*SPECS[name].schema().fields, T.StructField("value", T.StringType())]
    fields += [T.StructField(c, T.StringType()) for c in (REASON, STATUS)]
    if name == "customer_extended":
        fields.append(T.StructField(STREET_KEY, T.StringType()))
    if any(kind == "stamp" for _, kind in SPECS[name].fields):
        fields.append(T.StructField(PERIOD, T.IntegerType()))
    # the key stays text, whatever it looks like
    fields.append(T.StructField(BATCH, T.StringType()))
    return spark.read.schema(T.StructType(fields)).parquet(_path(out_dir, name))


def load_batches(
    spark: SparkSession, out_dir: str, name: str, batches: list[str] | None = None
) -> DataFrame:
    """Good rows of a table (of some batches, read as folders), with the spec's columns,
    ``_batch``, and ``_month`` or the street key where the table has them."""
    df = _stored(spark, out_dir, name).filter(F.col(STATUS) == "ok")
    if batches is not None:
        df = df.filter(F.col(BATCH).isin([_key(b) for b in batches]))
    return df.drop("value", REASON, STATUS)


def load_batch_quarantine(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    df = _stored(spark, out_dir, name).filter(F.col(STATUS) == "bad")
    return df.select("value", F.col(REASON).alias("reason"), BATCH)


def current_rows(rows: DataFrame, key: str) -> DataFrame:
    """Of the rows of each key those of its latest batch, one of them: for tables whose later
    batches replace earlier rows (products, customers).  Reduced before the shuffle.  Rows
    without a key are left out; of several rows of a key in one batch the one whose fields
    come last in the order of their values stays."""
    others = [c for c in rows.columns if c not in (key, BATCH)]
    latest = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.max(F.struct(BATCH, *others)).alias("row")
    )
    return latest.select(*(F.col(key) if c == key else F.col(f"row.{c}").alias(c) for c in rows.columns))
