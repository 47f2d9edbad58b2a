"""Session construction and shared-storage helpers.

Scratch output (files a job writes and reads back, lineage cuts) always lives
under the cluster's ``spark.checkpoint.dir``; a private directory is created
only when that setting is absent, which is the case in unit tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every session of this package relies on: UTC so dates never shift,
# ANSI so bad casts surface (tolerant casts use try_* explicitly), AQE so
# shuffle partition counts and join strategies adapt to runtime sizes.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # checkpoint files of unreferenced DataFrames are removed by the cleaner
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def cluster_settings(input_bytes: int, target_partition_bytes: int = 256 << 20,
                     max_partitions: int = 200_000) -> dict[str, str]:
    """Settings sized from the input volume for a cluster run.

    The initial shuffle width gives ~``target_partition_bytes`` per task for a
    shuffle as large as the input (AQE then coalesces small stages down to the
    advisory size), scans split files at the same size, and skew-join
    splitting kicks in for partitions 5× the median (a key holding a third of
    a table is split across many tasks).  Broadcasts stay size-checked by the
    threshold.  100 TB would need ~410 000 partitions of 256 MB; the cap keeps it
    at 200 000 (~512 MB per task before AQE re-plans).
    """
    parts = max(200, min(max_partitions, -(-input_bytes // target_partition_bytes)))
    size = str(target_partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }


def get_spark(master: str | None = None, app: str = "labelloop",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint directory; a private one is made only in local mode and only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="labelloop-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def share_code(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    For sessions started from another folder; a cluster's workers need the
    package at the same path, or installed.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([*known, root])


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"labelloop-{name}-{uuid.uuid4().hex[:12]}")


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete what was written under a path of :func:`scratch_path`; other paths are refused."""
    if not os.path.basename(path).startswith("labelloop-"):
        raise ValueError(f"{path} is not a scratch path")
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable lineage cut (survives executor loss), written to the checkpoint dir."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


class Held:
    """What the steps of a job keep for each other, deleted together once the job's own rows are stored:
    rows (compressed: vectors of one-hot columns take a small part of a checkpoint's bytes) and values sent to tasks."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths, self.values = spark, [], []

    def stored(self, df: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, "held")
        self.paths.append(path)
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def sent(self, value):
        self.values.append(self.spark.sparkContext.broadcast(value))
        return self.values[-1]

    def drop(self) -> None:
        for path in self.paths:
            drop_scratch(self.spark, path)
        for value in self.values:
            value.destroy()
        self.paths, self.values = [], []


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside, an action's shuffle files go when it ends, not when the driver happens to collect its garbage.

    For jobs that store what they use again: an action run twice on one DataFrame would shuffle twice."""
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
