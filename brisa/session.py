"""Session helpers: settings, the shared folder, and cutting a plan at a written table."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Adaptive execution splits skewed join keys. Forcing it pays a second shuffle where the
# join's partitioning would else be reused, and one key with a third of all rows would
# end up in one task.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# What one task takes, in bytes; a smaller setting of the cluster stays. Adaptive execution merges shuffle partitions into as few
# as there are cores until each has the advisory size. These are compressed bytes: the default of 64 MB of key pairs makes a hash
# table of some 3 GB once texts are joined to them. The tables are narrow selections of wide files, so a split of a file
# holds many more rows than its size tells.
AT_MOST = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 8 << 20,
    "spark.sql.files.maxPartitionBytes": 32 << 20,
}


def _bytes(setting: str) -> int:
    """Bytes of a size as Spark writes it: a number, then perhaps a unit such as k, m or gb."""
    number, unit = re.fullmatch(r"(\d+)\s*([bkmgtp]?)b?", setting.strip().lower()).groups()
    return int(number) << 10 * "bkmgtp".index(unit or "b")


def prepare(spark: SparkSession) -> None:
    """Adaptive execution on, tasks of bounded input. How many partitions a shuffle starts with is the cluster's setting."""
    for name, value in ADAPTIVE.items():
        spark.conf.set(name, value)
    for name, most in AT_MOST.items():
        if _bytes(spark.conf.get(name)) > most:
            spark.conf.set(name, str(most))


_own_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach, as the cluster names it.

    Only a local session without the setting gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _own_folders:
        _own_folders[context.applicationId] = tempfile.mkdtemp(prefix="brisa-")
    return _own_folders[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder, never used before."""
    return f"{shared_folder(spark)}/brisa/{label}-{uuid.uuid4().hex}"


def as_written_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The lineage ends at durable files, so a lost executor costs no recomputation,
    and the planner knows the exact size of the table: a following join is
    broadcast only if that size is below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    path = scratch_path(df.sparkSession, label)
    # nobody waits for the marker file of a folder that is read by its own writer
    df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
