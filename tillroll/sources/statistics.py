"""Ingested tables in the catalog, with statistics that month-restricted joins plan by.

A table read by its path has one size, that of all its files, however few months a question
reads.  So the month's sales never look small enough to filter the refunds before their
shuffle.  Registered in the catalog, the folders of the asked months are chosen while the
query is planned: the month's size is known, and Spark may build a runtime (bloom) filter
from the month's transaction ids and apply it to the scan of the refunds.  With
``spark.sql.cbo.enabled`` the row counts size that filter, too; without it, Spark assumes a
million ids, which lets nearly all refunds pass once a month has many more.

Statistics are computed over all rows, in one distributed scan of the key columns alone.
Columns of type TIMESTAMP_NTZ get none: Spark's estimation of a range over such a column
fails on its statistics.  The month column stands in for them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tillroll.functions.periods import PERIOD
from tillroll.sources.ingest import STATUS, load_bucketed

# what joins and filters of the questions use
KEYS = {
    "product": ("product_id",),
    "sales": ("transaction_id", "customer_id", "product_id", PERIOD, STATUS),
    "refund": ("original_transaction_id", PERIOD, STATUS),
    "customer": ("customer_id",),
    "customer_extended": ("id",),
}


def quoted(name: str) -> str:
    """``a.b`` as an SQL identifier, each part quoted."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def analyze(spark: SparkSession, table: str, columns: tuple[str, ...]) -> list[str]:
    """Statistics of the ``columns`` that the table has and Spark can estimate by (size and
    row count, if there is none of them); returns those columns."""
    types = {f.name: f.dataType for f in spark.table(quoted(table)).schema.fields}
    used = [c for c in columns if c in types and not isinstance(types[c], T.TimestampNTZType)]
    what = f" FOR COLUMNS {', '.join(quoted(c) for c in used)}" if used else ""
    spark.sql(f"ANALYZE TABLE {quoted(table)} COMPUTE STATISTICS{what}")
    return used


def register(
    spark: SparkSession, out_dir: str, tables: tuple[str, ...] = ("sales", "refund"),
    table_prefix: str = "",
) -> list[str]:
    """Register the folders that ``ingest(by_month=True)`` wrote as ``<table_prefix><name>``.

    The tables are external: files are neither moved nor copied, and dropping the table leaves
    them.  An existing table of the name is registered anew, so this is also what to call
    after another ingest: new months are found and statistics renewed.  Returns the names.
    """
    names = []
    for name in tables:
        table = f"{table_prefix}{name}"
        spark.sql(f"DROP TABLE IF EXISTS {quoted(table)}")
        spark.catalog.createTable(
            quoted(table), path=f"{out_dir.rstrip('/')}/{name}", source="parquet"
        )
        spark.catalog.recoverPartitions(quoted(table))
        analyze(spark, table, KEYS[name])
        names.append(table)
    return names


def load_registered(spark: SparkSession, name: str, table_prefix: str = "") -> DataFrame:
    """Good rows of a registered table, with ``_month`` if it has one."""
    return load_bucketed(spark, name, table_prefix)


def unregister(
    spark: SparkSession, tables: tuple[str, ...] = ("sales", "refund"), table_prefix: str = ""
) -> None:
    """Drop the catalog entries; the files stay."""
    for name in tables:
        spark.sql(f"DROP TABLE IF EXISTS {quoted(table_prefix + name)}")
