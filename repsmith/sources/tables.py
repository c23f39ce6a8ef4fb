"""Table materialisation and reads.

A staging "view" is just a lazy DataFrame (optionally registered as a temp view for SQL
users); a mart "table" is written once as Parquet and read back, which also cuts the
lineage of everything upstream. Writes go to a new version directory and a read picks
the newest complete one, so a reader never sees a half-written table and a failed job
leaves the previous version in place (never a static overwrite of the input being read).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException


def register_views(frames: dict[str, DataFrame]) -> None:
    """Expose lazy frames to SQL under their names."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def write_table(df: DataFrame, base_path: str, partition_by: list[str] | None = None) -> str:
    """Materialise ``df`` as a new version of the table at ``base_path``.

    The version directory name sorts by time (``v=<time>-<random>``); files become
    visible only at job commit."""
    millis = int(uuid.uuid1().time // 10_000)  # 100 ns ticks -> ms, monotonic enough for ordering
    path = f"{base_path.rstrip('/')}/v={millis:015d}-{uuid.uuid4().hex[:8]}"
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def read_table(spark: SparkSession, base_path: str, where: Column | str | None = None) -> DataFrame:
    """Newest committed version of a table written by :func:`write_table`, optionally
    filtered (S11; the predicate reaches the Parquet scan). The versions are the ``v=``
    partition directories: ``max(v)`` is one aggregate over partition values (no data
    columns are read, and only that scalar reaches the driver); uncommitted output lives in
    hidden temporary folders and is not listed."""
    try:
        versions = spark.read.parquet(base_path)
    except AnalysisException:
        raise FileNotFoundError(base_path)
    latest = versions.agg(F.max(F.col("v").cast("string")).alias("v")).first()["v"]
    if latest is None:
        raise FileNotFoundError(f"no committed version under {base_path}")
    df = spark.read.parquet(f"{base_path.rstrip('/')}/v={latest}")
    return df if where is None else df.where(where)
