"""The text parser over a file stream: new files in a folder become parquet rows.

The reference is batch only; this is the same ``parse`` applied to ``readStream.text``,
for data that keeps arriving. The file sink with a checkpoint gives exactly-once output
across restarts and lost executors. Unless a location is given, the checkpoint lives
under the session's ``spark.checkpoint.dir``, named after the table and output path.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from tillroll.functions.periods import PERIOD
from tillroll.session import checkpoint_dir
from tillroll.sources.ingest import STATUS, tag_status, with_derived
from tillroll.sources.schema import SPECS, TableSpec
from tillroll.sources.text import Parsed, parse


def stream_table(
    spark: SparkSession,
    path: str,
    spec: TableSpec | str,
    mode: str = "quarantine",
    max_files_per_trigger: int | None = None,
) -> Parsed:
    reader = spark.readStream.format("text")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return parse(reader.load(path), spec, mode=mode)


def _refuse_batch_folder(spark: SparkSession, out_dir: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(out_dir)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    if "_spark_metadata" not in names and any(not n.startswith(".") for n in names):
        raise ValueError(f"{out_dir} holds files that no stream wrote; choose another folder")


def start_ingest(
    spark: SparkSession,
    parsed: Parsed,
    out_dir: str,
    name: str,
    checkpoint_location: str | None = None,
    available_now: bool = True,
    by_month: bool = False,
) -> StreamingQuery:
    """Append parsed rows (ok and bad, partitioned by ``_status``) to ``out_dir``.

    With ``out_dir = <warehouse>/<name>`` the result has the batch ingest's layout and
    columns, so ``tillroll.sources.ingest.load(spark, <warehouse>, <name>)`` reads it;
    ``by_month`` adds the ``_month`` partition for period pruning.

    A folder that holds files of a batch ingest is refused: the file sink's log names the
    only files that readers then see, so the batch's rows would vanish. Give streams a
    folder of their own and union the two tables.
    """
    if name not in SPECS:
        raise ValueError(f"unknown table {name!r}")
    if checkpoint_location is None:
        # stable for the same output (a restart resumes), distinct between outputs
        digest = hashlib.sha1(out_dir.rstrip("/").encode()).hexdigest()[:16]
        checkpoint_location = f"{checkpoint_dir(spark)}/tillroll-stream-{name}-{digest}"
    _refuse_batch_folder(spark, out_dir)
    rows = with_derived(tag_status(parsed), name, by_month)
    partitions = [STATUS, *(c for c in (PERIOD,) if c in rows.columns)]
    writer = (
        rows.writeStream.format("parquet")
        .partitionBy(*partitions)
        .option("path", out_dir)
        .option("checkpointLocation", checkpoint_location)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
