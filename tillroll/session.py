"""Spark session construction and shared-storage locations."""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC session time zone (timestamp_ntz
# arithmetic and date parts must not depend on the host), adaptive execution
# (partition coalescing and skew-join splitting at runtime). Partitions are
# coalesced up to 16 MB as written: the sorts and hash tables of a task that
# joins and groups whole lines take some fifteen times that.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
PARTITION_ROWS = 200_000


def partitions_for(spark: SparkSession, rows: int) -> None:
    """Shuffles begin with a partition for every ``PARTITION_ROWS`` rows of the largest table, and no fewer than the
    session's; adaptive execution coalesces them, but can't cut those of too few partitions."""
    spark.conf.set(INITIAL_PARTITIONS, str(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // PARTITION_ROWS))))


def get_spark(
    master: str | None = None,
    app_name: str = "tillroll",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return the active session, or build one with the engine's defaults.

    On a cluster the master and sizing come from spark-submit; locally
    ``master`` defaults to ``local[$BENCH_CPUS or *]``.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        for k, v in BASE_CONF.items():
            active.conf.set(k, v)
        return active
    builder = SparkSession.builder.appName(app_name)
    if master is None and "SPARK_MASTER" not in os.environ:
        master = f"local[{os.environ.get('BENCH_CPUS', '*')}]"
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    conf.setdefault("spark.ui.enabled", "false")
    conf.setdefault("spark.ui.showConsoleProgress", "false")
    # concurrent jobs from several threads share executors fairly by pool
    conf.setdefault("spark.scheduler.mode", "FAIR")
    conf.setdefault("spark.driver.memory", os.environ.get("TILLROLL_DRIVER_MEMORY", "16g"))
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and materialised intermediate tables.

    Uses the cluster's ``spark.checkpoint.dir``. Only on a local master, where
    driver and tasks see one disk, an unset one is replaced by a folder under
    /tmp; on a cluster an unset one is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = os.path.join("/tmp", f"tillroll-ckpt-{uuid.uuid4().hex[:8]}")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


_SCRATCH: list[str] = []  # what this process has been given


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def drop_scratch(spark: SparkSession) -> None:
    """Delete what was written under this process's scratch paths, by whatever
    file system holds them. Results that still read from there are lost, so
    this is for the end of a job."""
    while _SCRATCH:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
