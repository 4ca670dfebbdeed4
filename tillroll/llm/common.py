"""Helpers shared by the operators: tables, the shared folder, Arrow batches."""

from __future__ import annotations

import ctypes
import functools
import gc
import inspect
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.session import checkpoint_dir

# Arrow batches are cut to about this many text bytes before any numpy work
CHUNK_BYTES = 1 << 20
# a side is broadcast only when it was counted and its rows take less than this
BROADCAST_BYTES = 32 << 20
# narrow rows, as counted, that one task takes without a shuffle
FEW_ROWS = 1 << 17


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_dir(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared folder of ``spark.checkpoint.dir``.

    Only a session on one machine (``local[...]``) may leave that unset; it then gets a
    temporary folder of this machine.
    """
    local = spark.sparkContext.master.startswith(("local[", "local")) and not (
        spark.sparkContext.master.startswith("local-cluster")
    )
    unset = not (
        spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    )
    fallback = tempfile.mkdtemp(prefix="tillroll-work-") if local and unset else None
    return f"{checkpoint_dir(spark, fallback=fallback)}/tillroll-{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the lineage
    with a copy that survives lost executors."""
    spark = df.sparkSession
    path = work_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _release() -> None:
    """Give the memory that a task has freed back to the system.  Python workers are kept for
    later tasks, and their allocators would keep it too, beside that of other workers."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


_CACHES: dict[str, dict] = {}


def worker_cache(owner: str) -> dict:
    """What a Python worker keeps across the tasks of the module ``owner``; it is emptied when
    the worker gets a task of another one."""
    return _CACHES.setdefault(owner, {})


def _released(function: Callable) -> Callable:
    owner = function.__module__

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for other in _CACHES.keys() - {owner}:
            _CACHES[other].clear()
        try:
            yield from function(batches)
        finally:
            _release()

    return run


_shipped: set[str] = set()


def map_arrow(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``df.mapInArrow`` after sending this package to the executors' Python workers (once
    per application), so that a plain ``spark-submit`` needs no ``--py-files``."""
    sc = df.sparkSession.sparkContext
    if sc.applicationId not in _shipped:
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = f"{tempfile.mkdtemp(prefix='tillroll-code-')}/tillroll_package.zip"
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(root):
                for name in sorted(n for n in names if n.endswith(".py")):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
        sc.addPyFile(path)
        _shipped.add(sc.applicationId)
    return df.mapInArrow(_released(function), schema)


def maybe_broadcast(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """Hint a broadcast only if ``rows`` counted rows stay below BROADCAST_BYTES; beyond
    it the planner joins by shuffle."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def are_few(rows: int) -> bool:
    return rows <= FEW_ROWS


def few(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in one partition if its counted ``rows`` are few (and narrow): grouping and joining
    them then take no shuffle, and so none of its tasks; else as it is."""
    return df.coalesce(1) if are_few(rows) else df


def clash_proof(*columns: str, reads: tuple[str, ...] = ()):
    """Decorator of an operator whose first argument is a DataFrame of which further columns
    pass through: these have other names inside, so that none clashes with a name the operator
    uses, and their own names again in the result.  ``columns`` are the arguments that name the
    columns it reads, ``reads`` the columns of fixed name.  A further column of the name of an
    added one is replaced by it (names compare without case)."""

    def wrap(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        signature = inspect.signature(operator)

        @functools.wraps(operator)
        def run(df: DataFrame, *args, **kwargs) -> DataFrame:
            bound = signature.bind(df, *args, **kwargs)
            bound.apply_defaults()
            own = {bound.arguments[c].lower() for c in columns} | {c.lower() for c in reads}
            inner = {c: c if c.lower() in own else f"further column {i}" for i, c in enumerate(df.columns)}
            held = df.select(*(F.col(f"`{c}`").alias(name) for c, name in inner.items()))
            out = operator(held, *args, **kwargs)
            outer = {name: c for c, name in inner.items()}
            added = {c.lower() for c in out.columns if c not in outer}
            return out.select(*(
                F.col(f"`{c}`").alias(outer.get(c, c)) for c in out.columns
                if c not in outer or outer[c].lower() not in added
            ))

        return run

    return wrap


def keyed(docs: DataFrame, id_col: str) -> tuple[DataFrame, int, int]:
    """``docs`` (id and ``_text``) with ``_row``, unique numbers in the order of (id, nulls
    last, text), which are the ids themselves if those are unique; rows; text bytes."""
    sizes = docs.agg(
        F.count("*"), F.count(id_col), F.sum(F.octet_length("_text")), F.countDistinct(id_col),
    ).first()
    rows, known, size, distinct = (x or 0 for x in sizes)
    if rows == known == distinct:
        return docs.withColumn("_row", F.col(id_col).cast("long")), rows, size
    ordered = docs.orderBy(F.col(id_col).asc_nulls_last(), "_text")
    return stored(ordered.withColumn("_row", F.monotonically_increasing_id()), "rows"), rows, size


def numbered(
    df: DataFrame, id_col: str, text_col: str, keep: list[str], ordered: bool = False
) -> tuple[DataFrame, int]:
    """(r: row number, t: text, the columns of ``keep`` as c0, c1, ..., so that no name of the
    caller clashes) and the bytes of all texts.  Whole ids that are unique are the numbers
    themselves; else rows are numbered, ``ordered`` by (id, nulls last, text) if asked for."""
    others = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)]
    text = F.col(f"`{text_col}`").cast("string").alias("t")
    ids = F.col(f"`{id_col}`")
    if isinstance(df.schema[id_col].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        rows, known, distinct, size = df.select(ids.alias("i"), text).agg(
            F.count("*"), F.count("i"), F.countDistinct("i"), F.sum(F.octet_length("t")),
        ).first()
        if rows == known == distinct:
            # coalesce: never null, which keeps all joins on one exchange of the texts
            return df.select(F.coalesce(ids.cast("long"), F.lit(0)).alias("r"), text, *others), size or 0
    rows = df.select(ids.alias("i"), text, *others)
    if ordered:
        rows = rows.orderBy(F.col("i").asc_nulls_last(), "t")
    columns = [f"c{i}" for i in range(len(keep))]
    rows = stored(rows.select(F.monotonically_increasing_id().alias("r"), "t", *columns), "rows")
    size = rows.agg(F.sum(F.octet_length("t"))).first()[0]
    return rows.withColumn("r", F.coalesce("r", F.lit(0))), size or 0


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose ``column`` holds about ``limit`` bytes (a longer
    single value stays whole)."""
    total, start = 0, 0
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield batch.slice(start, i - start)
            total, start = 0, i
        total += n
    if start < batch.num_rows:
        yield batch.slice(start)
