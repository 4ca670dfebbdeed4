"""Session settings the jobs rely on, applied only where the caller left them unset."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Adaptive execution re-plans at every shuffle boundary from measured sizes: it coalesces
# small shuffle partitions, splits skewed ones, and turns a sort-merge join into a
# broadcast join only when the materialised side is measured below the threshold.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # a filtered side (one month of orders) of up to this size may filter the other side
    # before its shuffle; the default of 10 MB rules that out on large tables
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g",
}


PARTITION_BYTES = 128 * 1024 * 1024


def initial_partitions(largest_shuffle_bytes: int) -> int:
    """Shuffle partitions so the largest shuffle starts at about 128 MB per partition
    (AQE coalesces from there); at least 200, at most 200,000."""
    return max(200, min(200_000, -(-largest_shuffle_bytes // PARTITION_BYTES)))


def tune(
    spark: SparkSession, largest_shuffle_bytes: int | None = None, **overrides: str
) -> SparkSession:
    """Apply DEFAULTS (then ``overrides``) for keys the session has not set itself.

    ``largest_shuffle_bytes`` (e.g. the size of the biggest table a job shuffles) also
    sizes ``spark.sql.adaptive.coalescePartitions.initialPartitionNum``.
    """
    wanted = {**DEFAULTS, **{k.replace("__", "."): v for k, v in overrides.items()}}
    if largest_shuffle_bytes is not None:
        wanted["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(
            initial_partitions(largest_shuffle_bytes)
        )
    for key, value in wanted.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    ``fallback`` is used (and installed) only when the session names none, as in tests
    on one machine; on a cluster the setting must point at shared storage.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if fallback is None:
        raise RuntimeError("spark.checkpoint.dir is not set and no fallback was given")
    sc.setCheckpointDir(fallback)
    return fallback.rstrip("/")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared checkpoint folder.  Only a session on one machine
    may leave ``spark.checkpoint.dir`` unset; it then gets a temporary folder."""
    master = spark.sparkContext.master
    one_machine = master.startswith("local") and not master.startswith("local-cluster")
    unset = not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir())
    fallback = tempfile.mkdtemp(prefix="tillroll-") if one_machine and unset else None
    return f"{checkpoint_dir(spark, fallback)}/tillroll-{label}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder of any file system that the session reaches; False if there is none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.exists(target) and files.delete(target, True)


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob, sorted."""
    target = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    return sorted(s.getPath().toString() for s in found or [])
