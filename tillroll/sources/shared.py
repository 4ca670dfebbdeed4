"""Tables that several questions of a job read: one copy in the shared folder.

The reference persists its parsed tables in executor memory.  A lost executor loses its part
of that, and the text is parsed again.  Here the tables are written below the folder of
``spark.checkpoint.dir`` and read back: each file is parsed once whatever happens to the
executors, later reads are pruned to the columns and row groups that they need, and the copy
is removed when the job ends.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tillroll.session import remove_path, scratch_dir


@contextmanager
def shared_copy(
    spark: SparkSession, tables: dict[str, DataFrame], names: tuple[str, ...] | None = None
) -> Iterator[dict[str, DataFrame]]:
    """``tables`` with those of ``names`` (all, by default) read from a stored copy, which is
    removed at the end of the ``with`` block, also after an error.

    Only a session on one machine may leave ``spark.checkpoint.dir`` unset.
    """
    base = scratch_dir(spark, "shared")
    out = dict(tables)
    try:
        for name in tables if names is None else names:
            tables[name].write.parquet(f"{base}/{name}")
            out[name] = spark.read.schema(tables[name].schema).parquet(f"{base}/{name}")
        yield out
    finally:
        remove_path(spark, base)
