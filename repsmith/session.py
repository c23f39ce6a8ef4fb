"""Session settings every job in this package assumes.

* Session time zone pinned to UTC, so ``TIMESTAMP_NTZ`` inputs and instants agree.
* ANSI mode on (Spark 4 default): division and casts are guarded explicitly.
* AQE on, with partition coalescing and skew-join splitting: hot keys in the
  sort-merge joins (one exercise / one athlete holding a third of all rows) are
  split at runtime instead of landing in one task.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

BASE_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def sized_conf(input_bytes: int, target_partition_bytes: int = 256 << 20,
               max_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Shuffle and scan sizing for a cluster run, from the input size.

    Initial shuffle partitions so each holds about ``target_partition_bytes`` (AQE then
    coalesces small ones and splits skewed ones at runtime), scan splits of
    ``max_partition_bytes``, and skew thresholds relative to the partition size. For
    100 TB at 256 MB this is ~400k initial partitions (AQE coalesces them)."""
    parts = max(200, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(max_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    }


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "repsmith", extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the package's settings.

    On a cluster pass ``master=None`` and let spark-submit decide; the shuffle
    partition count should then be sized to the input (about 128-256 MB per task).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", os.environ.get("REPSMITH_DRIVER_MEMORY", "8g"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k, v in conf.items():
        if not k.startswith(("spark.driver", "spark.ui", "spark.master")):
            if spark.conf.get(k, None) != v:
                spark.conf.set(k, v)  # a static setting that differs raises
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and versioned tables.

    Read from ``spark.checkpoint.dir`` (the cluster names it). Only a local-mode
    session without one gets a fresh scratch folder (tests); on a cluster a missing
    setting is an error, because a machine-local folder would not survive the loss
    of an executor.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="repsmith-ckpt-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def remove_tree(spark: SparkSession, path: str) -> None:
    """Remove a folder that this package made."""
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back, for results that are read from it: what made
    it runs once, however often it is used, and a lost executor reads it again."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/written-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staged(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``df`` written to the shared folder and read back, for the length of a ``with`` block.

    Cuts the lineage like a checkpoint (a lost executor reads it again), and the files are gone
    once what they were staged for is written."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/staged-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove_tree(spark, path)
