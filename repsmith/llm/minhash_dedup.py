"""MinHash near-duplicate detection with exact confirmation and star contraction.

Documents with equal shingle sets form one class and are carried as one node. Nodes meet
in the buckets of ``BANDS`` bands of ``ROWS`` minima. In each bucket every member is
compared with three leaders (linear, also for a hot bucket); confirmed links are
contracted by alternating large-star and small-star. What the leaders left apart is then
settled: members outside the bucket's largest component are compared with all members of
other components by signature, in blocks of about ``BLOCK`` x ``BLOCK``. A block returns a
spanning forest of its similar pairs, which gives families; within a family, each node present
once, the same comparison ends with the confirmation and returns only links. Two members of one component need no test, so no link
between components is lost and a large group of near copies never becomes all its pairs.

A link is confirmed on the full sets: 100 * intersection >= 85 * union. The banding
misses a pair at exactly that similarity with probability (1 - .85**5)**25 < 1e-6, the
signature check (four standard deviations) with about 3e-5.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repsmith.llm._common import marked, persisted
from repsmith.llm._text import SPACES, Words, shingle_sets, slices

SHINGLE, BANDS, ROWS, PERCENT, BLOCK = 5, 25, 5, 85, 1024
HASHES = BANDS * ROWS
_rng = np.random.default_rng(11)
_A = (_rng.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_B = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)[:, None]
SIGNATURE_LEAST = PERCENT / 100 - 4 * float(np.sqrt(PERCENT / 100 * (1 - PERCENT / 100) / HASHES))

SKETCH = "doc_id long, text_hash long, n_shingles long, digest binary, bands array<long>, sig binary"


def _minima(shingles: np.ndarray) -> np.ndarray:
    """The minimum of each universal hash a*x+b (modulo 2**32, a odd) over the set."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(x), 1024):
        np.minimum(least, (_A * x[None, at:at + 1024] + _B).min(axis=1), out=least)
    return least


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()),
                        ("bands", pa.list_(pa.int64())), ("sig", pa.binary())])
    for batch in batches:
        for lo, hi, data, offsets in slices(batch, "text"):
            sizes, digests, minima = [], [], []
            for s in shingle_sets(Words(data, offsets, SPACES), SHINGLE):
                sizes.append(len(s))
                digests.append(_digest(s) if len(s) else None)
                minima.append(_minima(s))
            m = np.stack(minima)
            key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), (len(m), BANDS)).copy()
            for r in range(ROWS):
                key = (key ^ m[:, r::ROWS].astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
                key ^= key >> np.uint64(32)
            short = ((m * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)
            bands = [k.view(np.int64) if n else [] for k, n in zip(key, sizes)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c).slice(lo, hi - lo) for c in ("doc_id", "text_hash")], pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                                              pa.array(bands, pa.list_(pa.int64())), pa.array([x.tobytes() for x in short], pa.binary())], schema=schema)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("node", pa.int64()), ("shingles", pa.binary())])
    for batch in batches:
        nodes, wanted = batch.column("node").to_pylist(), batch.column("digest").to_pylist()
        for lo, _, data, offsets in slices(batch, "text"):
            found = [(nodes[lo + i], s.tobytes()) for i, s in enumerate(shingle_sets(Words(data, offsets, SPACES), SHINGLE)) if len(s) and _digest(s) == wanted[lo + i]]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.binary())], schema=schema)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), HASHES)


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            same = (_matrix(batch.column("sig_a")) == _matrix(batch.column("sig_b"))).mean(axis=1)
            yield batch.select(["a", "b"]).filter(pa.array(_estimate(same) >= SIGNATURE_LEAST))


def _estimate(share: np.ndarray) -> np.ndarray:
    """Similarity from the share of equal one-byte minima (1/256 of unequal ones agree by chance)."""
    return (share - 1 / 256) / (1 - 1 / 256)


def _linkable(x: np.ndarray, y: np.ndarray) -> bool:
    """100 * intersection >= PERCENT * union, for sorted distinct values."""
    if 100 * min(len(x), len(y)) < PERCENT * max(len(x), len(y)):
        return False
    both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
    return 100 * both >= PERCENT * (len(x) + len(y) - both)


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            keep = [_linkable(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)) for x, y in zip(batch.column("set_a"), batch.column("set_b"))]
            yield batch.select(["a", "b"]).filter(pa.array(keep))


def _blocks(compare: Callable[[pa.Table], list[tuple[int, int]]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Applies ``compare`` to each (key, i, j) of rows sorted so; returns its pairs (a, b)."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def out(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        found = compare(rows.combine_chunks())
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            cell = np.stack([held.column(c).to_numpy() for c in ("key", "i", "j")])
            cuts = np.flatnonzero((cell[:, 1:] != cell[:, :-1]).any(axis=0)) + 1
            for lo, hi in zip([0, *cuts[:-1]], cuts):
                yield from out(held.slice(lo, hi - lo))
            held = held.slice(cuts[-1]) if len(cuts) else held
        if held is not None:
            yield from out(held)
    return run


def _similar_members(rows: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """(row of a query, rows of the block's members with another root and a similar signature, most similar first)."""
    query = rows.column("query").to_numpy().astype(bool)
    root, sig = rows.column("root").to_numpy(), _matrix(rows.column("sig").combine_chunks())
    members = np.flatnonzero(~query)
    root_m, sig_m = root[members], sig[members]
    for at in np.flatnonzero(query):
        other = np.flatnonzero(root_m != root[at])
        like = _estimate((sig_m[other] == sig[at]).mean(axis=1)) if len(other) else np.zeros(0)
        order = np.argsort(-like, kind="stable")
        yield at, members[other[order[like[order] >= SIGNATURE_LEAST]]]


def _families(rows: pa.Table) -> list[tuple[int, int]]:
    """A spanning forest of the block's similar pairs: fewer edges than rows."""
    node = rows.column("node").to_numpy()
    _, label = np.unique(node, return_inverse=True)
    names = np.unique(node)
    family = np.arange(len(names))
    for at, near in _similar_members(rows):
        joined = family[np.append(label[near], label[at])]
        least = joined.min()
        if (joined != least).any():
            family[np.isin(family, joined)] = least
    return [(int(names[f]), int(n)) for n, f in zip(names, family) if names[f] != n]


def _linked(rows: pa.Table) -> list[tuple[int, int]]:
    """Per query one confirmed link to each other root that has one in the block."""
    node, root, sets = rows.column("node").to_pylist(), rows.column("root").to_pylist(), [np.frombuffer(x.as_buffer(), np.uint64) for x in rows.column("shingles").combine_chunks()]
    found = []
    for at, near in _similar_members(rows):
        done = set()
        for m in near:
            if root[m] not in done and _linkable(sets[at], sets[m]):
                done.add(root[m])
                found.append((node[at], node[m]))
    return found


def star_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long); root is the smallest node reachable.

    Alternating large-star and small-star until the edges stop changing. Each step is a
    combined minimum per node and a join (a hot node is split by AQE), and its result is
    written to the shared folder. Self-loops and repeated edges are allowed; null ends are dropped."""
    edges = persisted(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("a is not null and b is not null and a <> b").distinct(), "star")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        pair = lambda x: F.struct(F.col(x).alias("u"), F.col("m").alias("v"))
        small = large.join(least, "u").select(F.explode(F.array(pair("u"), pair("v"))).alias("e")).select("e.u", "e.v").where("u <> v").distinct()
        edges = persisted(small, "star")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept, text_hash (xxhash64 of the text).

    Null or wordless text: n_shingles 0, its own component, kept. Rows that repeat a
    doc_id and text are one class; rows that share a doc_id with different texts keep
    their own component each. A null doc_id never becomes a component's id unless all its
    members have none (then component_id is null and the row is kept). Columns besides the
    two named ones are ignored; an empty table gives an empty result."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sketch = persisted(docs.withColumn("text_hash", F.xxhash64("text")).mapInArrow(_sketch, SKETCH), "sketch")
    nodes = (sketch.where("digest is not null").groupBy("digest")
             .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("sig").alias("sig"))
             .withColumn("node", F.monotonically_increasing_id()))
    nodes = persisted(nodes, "nodes")

    buckets = nodes.select("node", F.explode("bands").alias("key"))
    shared = (buckets.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.min("node").alias("l0"), F.max("node").alias("l1"), F.min_by("node", F.xxhash64("node")).alias("l2"))
              .where("members > 1"))
    members = persisted(buckets.join(shared, "key"), "members")
    led = members.select(F.explode(F.array_distinct(F.array("l0", "l1", "l2"))).alias("leader"), "node").where("leader <> node")
    pairs = led.select(F.least("leader", "node").alias("a"), F.greatest("leader", "node").alias("b")).distinct()

    def signed(p: DataFrame) -> DataFrame:
        """Signature and size verification of (a, b)."""
        side = lambda c: nodes.select(F.col("node").alias(c), F.col("sig").alias(f"sig_{c}"), F.col("n").alias(f"n_{c}"))
        fits = f"100 * least(n_a, n_b) >= {PERCENT} * greatest(n_a, n_b)"
        return p.join(side("a"), "a").join(side("b"), "b").where(fits).select("a", "b", "sig_a", "sig_b").mapInArrow(_similar, "a long, b long")

    def sets_of(wanted: DataFrame) -> DataFrame:
        """(node, shingles), rebuilt from the text of one document per node; only texts that a fixed map
        of the wanted ids lets through are shuffled, and the sort-merge join holds at any size."""
        wanted = persisted(wanted.join(nodes.select("node", "rep", "digest"), "node"), "wanted")
        likely = marked(docs, [F.col("doc_id")], wanted, [F.col("rep")]).where("_maybe")
        texts = likely.join(wanted.hint("merge"), likely.doc_id.eqNullSafe(wanted.rep)).select("node", "digest", "text")
        return persisted(texts.mapInArrow(_sets, "node long, shingles binary"), "sets")

    similar = persisted(signed(pairs), "similar")
    sets = sets_of(similar.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    side = lambda c: sets.select(F.col("node").alias(c), F.col("shingles").alias(f"set_{c}"))
    links = similar.join(side("a"), "a").join(side("b"), "b").select("a", "b", "set_a", "set_b").mapInArrow(_confirm, "a long, b long")
    roots = persisted(star_components(persisted(links, "links")), "roots")

    def blocks(rows: DataFrame) -> DataFrame:
        """(key, node, root) laid out for ``_blocks``: per key with more than one root, the rows outside
        the largest root as queries against all rows, in blocks of about BLOCK x BLOCK."""
        sizes = rows.groupBy("key", "root").agg(F.count(F.lit(1)).alias("k"))
        main = (sizes.groupBy("key").agg(F.max_by("root", F.struct("k", "root")).alias("main"), F.count(F.lit(1)).alias("roots"), F.sum("k").alias("m"), F.max("k").alias("most"))
                .where("roots > 1")
                .select("key", "main", F.ceil(F.col("m") / BLOCK).alias("cells_m"), F.ceil((F.col("m") - F.col("most")) / BLOCK).alias("cells_q")))
        open_ = persisted(rows.join(main, "key"), "open")
        spread = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
        own = lambda n: F.pmod(F.xxhash64("node"), n)
        queries = open_.where("root <> main").select("key", "node", "root", own(F.col("cells_q")).alias("i"), spread(F.col("cells_m")).alias("j"), F.lit(True).alias("query"))
        others = open_.select("key", "node", "root", spread(F.col("cells_q")).alias("i"), own(F.col("cells_m")).alias("j"), F.lit(False).alias("query"))
        return queries.unionByName(others).join(nodes.select("node", "sig"), "node")

    def compared(cells: DataFrame, compare: Callable[[pa.Table], list[tuple[int, int]]], name: str) -> DataFrame:
        return persisted(cells.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(_blocks(compare), "a long, b long").distinct(), name)

    rooted = members.select("key", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    families = persisted(star_components(compared(blocks(rooted), _families, "similar")), "families")
    # A family's members are compared once, not once per bucket, and on their sets.
    family = families.select("node", F.col("root").alias("key")).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    more = compared(blocks(family).join(sets_of(families.select("node")), "node"), _linked, "links")
    final = persisted(star_components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more)), "roots")

    classes = nodes.select("node", "digest", "rep").join(final, "node", "left").withColumn("root", F.coalesce("root", "node"))
    best = classes.groupBy("root").agg(F.min("rep").alias("component_id"))
    labels = classes.join(best, "root").select("digest", "component_id")
    out = sketch.select("doc_id", "text_hash", "n_shingles", "digest").join(labels, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "text_hash")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: one per component, all wordless ones. Of rows that repeat
    the kept document's id (or have no id at all), those with the same text stay once."""
    verdict = near_duplicates(docs, id_col, text_col)
    gone = persisted(verdict.where(~F.col("kept")).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct(), "gone")
    key = [F.col(id_col).cast("long").alias("_id"), F.xxhash64(F.col(text_col).cast("string")).alias("_hash")]
    # Most rows surely stay and are not shuffled.
    names = [f"_c{i}" for i in range(len(docs.columns))]
    of = dict(zip(docs.columns, names))
    mine = [F.col(of[id_col]).cast("long"), F.xxhash64(F.col(of[text_col]).cast("string"))]
    sorted_out = marked(docs.toDF(*names), mine, gone, [F.col("_id"), F.col("_hash")])
    asked = sorted_out.where("_maybe").join(gone.hint("merge"), mine[0].eqNullSafe(gone["_id"]) & (mine[1] == gone["_hash"]), "left_anti")
    stay = sorted_out.where("not _maybe").unionByName(asked).select(*names).toDF(*docs.columns)
    repeated = docs.select(*key).groupBy("_id", "_hash").count().where("count > 1")
    return stay if repeated.isEmpty() else stay.dropDuplicates([id_col, text_col])
