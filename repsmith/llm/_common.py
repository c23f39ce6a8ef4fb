"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from repsmith.session import checkpoint_dir


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder named by ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def persisted(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage: a lost executor costs the tasks it was running, never the stages
    before this one."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow`` that hands what the allocators keep back to the system at its end:
    the worker process lives on for other tasks and stages."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
        if trim:
            trim(0)
    return rows


#: Bits of the map that ``marked`` broadcasts: 8 MB, whatever the input's size.
MAP_BITS = 1 << 26


def marked(df: DataFrame, key: list[Column], wanted: DataFrame, wanted_key: list[Column], name: str = "_maybe") -> DataFrame:
    """Add the boolean ``name``: false only where ``key`` is surely not among the keys of ``wanted``.

    One bit of a fixed map per key hash (nulls are keys too), so wide rows that a join would drop
    need not be shuffled for it. What is marked true still has to be joined: with many more keys
    than bits nearly every row is, and the join works as without the map. Keys are dealt to the
    pieces of the map before they are aggregated, so nothing but 8 bytes a key is shuffled."""
    bit = lambda k: F.pmod(F.xxhash64(*k), F.lit(MAP_BITS)) + 1
    bits = wanted.select(bit(wanted_key).alias("_b")).distinct().select(F.bitmap_bucket_number("_b").alias("_piece"), F.bitmap_bit_position("_b").alias("_at"))
    pieces = bits.repartition("_piece").groupBy("_piece").agg(F.bitmap_construct_agg("_at").alias("_bitmap"))
    at = F.bitmap_bit_position("_own")
    byte = F.conv(F.hex(F.substring("_bitmap", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = df.withColumn("_own", bit(key)).join(F.broadcast(pieces), F.bitmap_bucket_number("_own") == F.col("_piece"), "left")
    return found.withColumn(name, F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))).drop("_own", "_piece", "_bitmap")


def group_rank(df: DataFrame, group: list[str], order: list[str], salt: list[Column], rank: str) -> DataFrame:
    """Add ``rank``: a gapless number from 0 within each ``group``, exact for hot groups.

    Rows are numbered inside (group, cell), where the cell is a hash of ``salt``, and the
    cell's offset (a running sum over the group's at most ``cells`` counts) is added. A
    group that holds a third of all rows is thus spread over ``cells`` window partitions.
    Equal rows may swap numbers; nothing else depends on the partitioning. ``df`` must be
    cheap to read twice (a written table)."""
    spark = df.sparkSession
    cells = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    salted = df.withColumn("_cell", F.pmod(F.xxhash64(*salt), F.lit(cells)))
    counts = salted.groupBy(*group, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_cell").alias("_c"),
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy(*group, "_cell").orderBy(*order)
    cond = F.col("_cell") == F.col("_c")
    for i, g in enumerate(group):
        cond = cond & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return (salted.withColumn("_rn", F.row_number().over(inside)).join(offsets, cond)
            .withColumn(rank, F.col("_off") + F.col("_rn") - 1)
            .drop("_cell", "_rn", "_c", "_off", *[f"_g{i}" for i in range(len(group))]))
