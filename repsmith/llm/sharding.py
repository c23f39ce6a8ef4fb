"""Consistent-hash ring with virtual nodes and bounded loads.

Every shard has ``vnodes`` points on the ring; a row goes to the shard of the next point
clockwise of its id's hash, and where that shard is full, to the next shard clockwise that
is not. A full shard keeps the rows whose walk so far is shortest, then those that come
first by hash. All rows of one arc (between two neighbouring points) walk through the same
shards, so the walk is done on one count per arc (``shards * vnodes`` numbers, whatever the
corpus) and yields for each arc which of its rows, by number, go where. Spark numbers the
rows within their arcs.

With ``slack`` 0 the loads are equal (counts at most one apart); with a larger slack fewer
rows leave their first shard. Changing the number of shards moves the rows of the arcs that
change hands and what overflows because of them.
"""

from __future__ import annotations

import math
from bisect import bisect_left

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repsmith.llm._common import group_rank, persisted

VNODES, CELL_BITS = 128, 14


def ring(spark: SparkSession, shards: int, vnodes: int = VNODES) -> list[tuple[int, int]]:
    """(position, shard) of the virtual nodes in ring order; ``shards * vnodes`` points."""
    points = spark.range(shards * vnodes).select(F.xxhash64(F.col("id") % shards, F.floor(F.col("id") / shards), F.lit("vnode")).alias("p"), (F.col("id") % shards).alias("s"))
    return sorted((r["p"], r["s"]) for r in points.collect())


def walk(counts: list[int], owners: list[int], shards: int, slack: float = 0.0) -> list[list[tuple[int, int, int]]]:
    """Per arc the runs (first number, shard, first slot) of its rows; ``owners[i]`` is arc i's shard.

    Shard s holds at most ceil((1 + slack) * n / shards) rows; without slack the first n % shards
    shards hold one more than the others, which fills all exactly."""
    n, arcs = sum(counts), len(owners)
    if slack:
        room = [math.ceil((1 + slack) * n / shards)] * shards
    else:
        room = [n // shards + (s < n % shards) for s in range(shards)]
    filled, left, first = [0] * shards, list(counts), [0] * arcs
    runs: list[list[tuple[int, int, int]]] = [[] for _ in owners]
    order: list[list[int]] = []
    for arc in range(arcs):
        seen: dict[int, None] = {}
        for step in range(arcs):
            seen.setdefault(owners[(arc + step) % arcs])
            if len(seen) == shards:
                break
        order.append(list(seen))
    for step in range(shards):
        for arc in range(arcs):
            if left[arc] and step < len(order[arc]):
                s = order[arc][step]
                take = min(left[arc], room[s] - filled[s])
                if take:
                    runs[arc].append((first[arc], s, filled[s]))
                    filled[s] += take
                    left[arc] -= take
                    first[arc] += take
    return runs


def bounded_ring(df: DataFrame, shards: int, key: str = "doc_id", vnodes: int = VNODES, slack: float = 0.0) -> DataFrame:
    """``df`` with shard (int) and slot (long, gapless from 0 in each shard).

    Null keys hash like any value; rows with one key share an arc and are numbered in any order
    there. ``df`` is written first (it is read twice), so pass only the columns needed."""
    spark = df.sparkSession
    points = ring(spark, shards, vnodes)
    positions = [p for p, _ in points]
    owners = [s for _, s in points]
    cells = 1 << CELL_BITS
    width = 1 << (64 - CELL_BITS)
    edges = [-(1 << 63) + c * width for c in range(cells + 1)]
    per_cell = [(c, bisect_left(positions, edges[c]), positions[bisect_left(positions, edges[c]):bisect_left(positions, edges[c + 1])]) for c in range(cells)]
    lookup = spark.createDataFrame(per_cell, "_c int, _base int, _points array<long>")
    spot = F.xxhash64(key)
    placed = df.withColumn("_p", spot).withColumn("_c", F.shiftright(F.col("_p"), 64 - CELL_BITS).cast("int") + (1 << (CELL_BITS - 1)))
    # One row per ring cell: bounded by CELL_BITS, so it may be broadcast.
    placed = placed.join(F.broadcast(lookup), "_c").withColumn("_arc", (F.col("_base") + F.size(F.filter("_points", lambda p: p < F.col("_p")))) % len(points))
    written = persisted(placed.select(*df.columns, "_p", "_arc"), "ring")
    counts = [0] * len(points)
    for r in written.groupBy("_arc").count().collect():  # at most shards * vnodes rows
        counts[r["_arc"]] = r["count"]
    runs = walk(counts, owners, shards, slack)
    # One row per arc with at most `shards` runs: bounded by the ring.
    table = spark.createDataFrame([(a, [{"first": f, "shard": s, "slot": b} for f, s, b in r]) for a, r in enumerate(runs)], "_arc int, _runs array<struct<first: long, shard: int, slot: long>>")
    ranked = group_rank(written, ["_arc"], ["_p", key], [F.col("_p"), F.spark_partition_id()], "_n")
    run = F.element_at(F.filter("_runs", lambda x: x["first"] <= F.col("_n")), -1)
    return (ranked.join(F.broadcast(table), "_arc").withColumn("_run", run)
            .select(*df.columns, F.col("_run.shard").alias("shard"), (F.col("_run.slot") + F.col("_n") - F.col("_run.first")).alias("slot")))
