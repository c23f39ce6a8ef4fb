"""Lloyd's clustering with the dimensions dealt to column blocks.

Vectors are stored once as tiles: up to TILE_ROWS rows of one column block, in the narrowest
integer type that holds them. A round has two passes over the tiles. First every tile task gets
the centroid slice of its own block and computes the exact partial squared distances; a shuffle
by row chunk adds the blocks of a chunk and takes the argmin. Then the cluster numbers (two bytes
a row) go back to the tiles, every block adds its columns per cluster, one partial sum per task,
and updates its own slice. Whole vectors and whole centroids meet nowhere.

All arithmetic is in 64-bit integers, so the result does not depend on partitioning or order.
Slices hold ``clusters * dims`` numbers in all, whatever the table's size; only they are broadcast.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repsmith.llm._common import persisted

TILE_ROWS, BLOCK_DIMS, SCALE = 1024, 32, 64
TILES = "chunk long, block int, rows int, width int, bytes int, data binary, ids array<long>, starts array<struct<late: boolean, hash: string, vec_id: long, x: array<long>>>"


def _limit(dims: int) -> int:
    """Components below this cannot overflow a 64-bit squared distance."""
    return int((2 ** 63 / dims) ** 0.5) // 2


def _whole(batch: pa.RecordBatch, dims: int) -> tuple[pa.Array, np.ndarray]:
    """(ids, components as integers) of the rows with exactly ``dims`` finite components."""
    fits = pc.fill_null(pc.equal(pc.list_value_length(batch.column("x")), dims), False)
    batch = batch.filter(fits)
    x = batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, dims)
    finite = np.isfinite(x).all(axis=1)
    x = np.floor(SCALE * x[finite])
    if x.size and np.abs(x).max() >= _limit(dims):
        raise ValueError(f"a component of {_limit(dims) // SCALE} or more has no squared distance in 64 bits")
    return batch.column("vec_id").filter(pa.array(finite)), x.astype(np.int64)


def _tile_rows(chunk: int, ids: pa.Array, x: np.ndarray, clusters: int, seed: str) -> pa.RecordBatch:
    values = ids.to_pylist()
    first = heapq.nsmallest(clusters, ((v is None, hashlib.sha256(f"{seed}:{v}".encode()).hexdigest(), v if v is not None else 0, x[i].tolist()) for i, v in enumerate(values)))
    starts = [{"late": late, "hash": h, "vec_id": v, "x": c} for late, h, v, c in first]
    rows = []
    for block, lo in enumerate(range(0, x.shape[1], BLOCK_DIMS)):
        own = x[:, lo:lo + BLOCK_DIMS]
        size = next(b for b in (1, 2, 4, 8) if b == 8 or (own.min() >= -(1 << (8 * b - 1)) and own.max() < 1 << (8 * b - 1)))
        rows.append((chunk, block, len(own), own.shape[1], size, own.astype(f"<i{size}").tobytes(), values if block == 0 else None, starts if block == 0 else None))
    schema = pa.schema([("chunk", pa.int64()), ("block", pa.int32()), ("rows", pa.int32()), ("width", pa.int32()), ("bytes", pa.int32()), ("data", pa.binary()), ("ids", pa.list_(pa.int64())),
                        ("starts", pa.list_(pa.struct([("late", pa.bool_()), ("hash", pa.string()), ("vec_id", pa.int64()), ("x", pa.list_(pa.int64()))])))])
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def tiles(vectors: DataFrame, dims: int, clusters: int, seed: str, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Tiles of the kept vectors, written; a chunk's first tile also has its ids and its ``clusters`` best starts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        chunk = TaskContext.get().partitionId() << 32
        ids: list[pa.Array] = []
        held: list[np.ndarray] = []
        for batch in batches:
            some, x = _whole(batch, dims)
            for lo in range(0, len(x), TILE_ROWS):
                ids.append(some[lo:lo + TILE_ROWS])
                held.append(x[lo:lo + TILE_ROWS])
                if sum(map(len, held)) >= TILE_ROWS:
                    yield _tile_rows(chunk, pa.concat_arrays(ids), np.concatenate(held), clusters, seed)
                    chunk, ids, held = chunk + 1, [], []
        if held:
            yield _tile_rows(chunk, pa.concat_arrays(ids), np.concatenate(held), clusters, seed)
    plain = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("x"))
    return persisted(plain.mapInArrow(run, TILES), "tiles")


def _matrix(row: dict) -> np.ndarray:
    return np.frombuffer(row["data"], f"<i{row['bytes']}").reshape(row["rows"], row["width"]).astype(np.int64)


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {n: c[i].as_py() for n, c in zip(batch.schema.names, batch.columns)}


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in _rows_of(batches):
        x, slices = _matrix(row), np.array(row["slice"], np.int64).reshape(-1, row["width"])
        part = np.empty((len(x), len(slices)), np.int64)
        for j, c in enumerate(slices):
            apart = x - c
            part[:, j] = np.einsum("ij,ij->i", apart, apart)
        kind = "<u4" if part.max() < 1 << 32 else "<i8"
        yield pa.RecordBatch.from_pydict({"chunk": pa.array([row["chunk"]], pa.int64()), "rows": pa.array([row["rows"]], pa.int32()), "part": pa.array([part.astype(kind).tobytes()], pa.binary()), "kind": pa.array([kind])})


def _nearest(with_distance: bool):
    def run(table: pa.Table) -> pa.Table:
        rows = table.column("rows")[0].as_py()
        total = sum(np.frombuffer(p, k).reshape(rows, -1).astype(np.int64) for p, k in zip(table.column("part").to_pylist(), table.column("kind").to_pylist()))
        own = total.argmin(axis=1)  # ties: the smaller number
        distance = total[np.arange(rows), own].astype("<i8").tobytes() if with_distance else b""
        return pa.table({"chunk": pa.array([table.column("chunk")[0].as_py()], pa.int64()), "cluster": pa.array([own.astype("<u4").tobytes()], pa.binary()), "distance": pa.array([distance], pa.binary())})
    return run


def assign(stored: DataFrame, centroids: DataFrame, with_distance: bool = False) -> DataFrame:
    """Per chunk the nearest centroid of its rows (and the squared distance), packed.

    ``centroids``: block, cluster, d, value; ``clusters * dims`` rows, so a broadcast of them is bounded."""
    slices = centroids.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("cluster", "d", "value"))).alias("s")).select(F.col("block").alias("_block"), F.col("s.value").alias("slice"))
    own = stored.select("chunk", "block", "rows", "width", "bytes", "data").join(F.broadcast(slices), F.col("block") == F.col("_block")).drop("_block")
    parts = own.mapInArrow(_partial, "chunk long, rows int, part binary, kind string")
    return parts.groupBy("chunk").applyInArrow(_nearest(with_distance), "chunk long, cluster binary, distance binary")


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, tuple[dict[int, int], dict[int, np.ndarray]]] = {}
    for row in _rows_of(batches):
        x, own = _matrix(row), np.frombuffer(row["cluster"], "<u4")
        n, total = held.setdefault(row["block"], ({}, {}))
        for c in np.unique(own).tolist():
            mine = x[own == c]
            n[c] = n.get(c, 0) + len(mine)
            total[c] = total.get(c, 0) + mine.sum(axis=0)
    out = [(block, c, d, int(v), n[c]) for block, (n, total) in held.items() for c, values in total.items() for d, v in enumerate(values)]
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()))], names=["block", "cluster", "d", "s", "n"])


def update(stored: DataFrame, near: DataFrame, centroids: DataFrame) -> DataFrame:
    """New slices: floor of the mean of each cluster's columns; a cluster without rows keeps its slice."""
    back = stored.select("chunk", "block", "rows", "width", "bytes", "data").join(near.select("chunk", "cluster"), "chunk")
    sums = back.mapInArrow(_sums, "block int, cluster int, d int, s long, n long").groupBy("block", "cluster", "d").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    moved = sums.select("block", "cluster", "d", F.expr("(s - pmod(s, n)) div n").alias("_new"))
    return centroids.join(moved, ["block", "cluster", "d"], "left").select("block", "cluster", "d", F.coalesce("_new", "value").alias("value"))


def starting_slices(stored: DataFrame, clusters: int) -> DataFrame:
    """The start vectors of smallest hash as slices; rows without an id come last, equal hashes by content."""
    best = stored.where("block = 0").select(F.explode("starts").alias("s")).select("s.*").orderBy("late", "hash", "x").limit(clusters)
    numbered = best.withColumn("cluster", F.row_number().over(Window.orderBy("late", "hash", "x")).cast("int") - 1)  # `clusters` rows
    return numbered.select("cluster", F.posexplode("x").alias("at", "value")).select(F.floor(F.col("at") / BLOCK_DIMS).cast("int").alias("block"), "cluster", F.expr(f"at % {BLOCK_DIMS}").alias("d"), "value")


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in _rows_of(batches):
        yield pa.RecordBatch.from_pydict({"vec_id": pa.array(row["ids"], pa.int64()), "cluster": pa.array(np.frombuffer(row["cluster"], "<u4").astype(np.int32)), "distance": pa.array(np.frombuffer(row["distance"], "<i8"))})


def lloyd(vectors: DataFrame, dims: int, clusters: int, rounds: int, seed: str = "1", id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Per kept vector: vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256.

    Kept are vectors of exactly ``dims`` components, none null, NaN or infinite; a component x counts
    as floor(64 x), and one too large for 64-bit distances raises. Start: the ``clusters`` kept vectors
    with the smallest sha256 of "seed:id" (null ids last, fewer vectors: fewer clusters). Rows that
    repeat an id are separate vectors. Further columns are ignored; no kept vector gives no row."""
    spark = vectors.sparkSession
    stored = tiles(vectors, dims, clusters, seed, id_col, vec_col)
    centroids = persisted(starting_slices(stored, clusters), "slices")
    for _ in range(rounds):
        centroids = persisted(update(stored, assign(stored, centroids), centroids), "slices")
    last = assign(stored, centroids, with_distance=True)
    ids = stored.where("block = 0").select("chunk", "ids")
    placed = persisted(ids.join(last, "chunk").mapInArrow(_unpack, "vec_id long, cluster int, distance long"), "clusters")
    inertia = {r["cluster"]: r["s"] for r in placed.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # a row per cluster
    final: dict[int, list[int]] = {}
    for r in centroids.orderBy("cluster", "block", "d").collect():  # clusters * dims rows
        final.setdefault(r["cluster"], []).append(r["value"])
    facts = [(c, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, final[c])).encode()).hexdigest()) for c in sorted(inertia)]
    table = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(table), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
