"""Ranked lexical search over deduplicated bags of words.

Only the words of the items can score, so every text is reduced to its counts of those words and
its length class m. Documents with equal counts and equal m score alike for every item: they form
one class. Classes are found by a hash of (counts, m) and told apart by the counts themselves, each
is scored once, and its members follow by ascending id.

Texts are read once per block of items (ITEM_TERMS words); what is shuffled are counts, and of a
class that many rows share at most ``top`` rows per task, as no item can list more of them. Every
task keeps its ``top`` best per item, so the last shuffle holds tasks * items * top small rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from repsmith.llm._common import persisted
from repsmith.llm._text import NON_WORD, Words, same_bytes, slices

#: (item, word) pairs of one block of items; more items take further passes over the texts.
ITEM_TERMS = 1 << 20
PAIRS = 1 << 21
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})
COUNTS = "doc_id long, n long, counts binary"


def terms_of(text: str) -> set[str]:
    return set(TERM.findall(text.translate(_LOWER)))


def item_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int | None, set[str]]]]:
    """Items (rows of one id are one item) in blocks of about ITEM_TERMS words, streamed in id order."""
    block: list[tuple[int | None, set[str]]] = []
    size = 0
    for r in items.select(F.col(id_col).cast("long").alias("i"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t")).orderBy("i").toLocalIterator():
        own = terms_of(r["t"])
        if block and block[-1][0] == r["i"]:
            size += len(own - block[-1][1])
            block[-1][1].update(own)
            continue
        if size + len(own) > ITEM_TERMS and block:
            yield block
            block, size = [], 0
        block.append((r["i"], own))
        size += len(own)
    if block:
        yield block


def _counter(words: list[bytes]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows to (doc_id, n, counts): little-endian pairs (word number, occurrences) of ``words``, ascending."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat = np.frombuffer(b"".join(words), np.uint8)
        offsets = np.concatenate(([0], np.cumsum([len(w) for w in words]))).astype(np.int64)
        keys = Words(flat, offsets, NON_WORD).hash
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        for batch in batches:
            for lo, hi, data, at in slices(batch, "text"):
                found = Words(data, at, NON_WORD)
                spot = np.minimum(np.searchsorted(keys, found.hash), len(keys) - 1)
                hit = np.flatnonzero(keys[spot] == found.hash)
                number, row = order[spot[hit]], found.rows()[hit]
                sure = same_bytes(NON_WORD[data], found.starts[hit], found.ends[hit], flat, offsets[number], offsets[number + 1])
                number, row = number[sure], row[sure]
                pair, times = np.unique(row * len(keys) + number, return_counts=True)
                packed = np.column_stack((pair % len(keys), times)).astype("<u4")
                cut = np.searchsorted(pair, np.arange(hi - lo + 1) * len(keys))
                ids = batch.column("doc_id").slice(lo, hi - lo)
                yield pa.RecordBatch.from_pydict({"doc_id": ids, "n": pa.array(np.diff(found.bounds), pa.int64()), "counts": pa.array([packed[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary())})
    return run


def word_counts(docs: DataFrame, words: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row doc_id, n (all its words, with repeats) and counts of ``words`` in its whole text; null text: none."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(_counter([w.encode() for w in words]), COUNTS)


def document_frequency(counted: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each of ``size`` words: one partial sum per task, then one row per word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            held = np.frombuffer(b"".join(batch.column("counts").to_pylist()), "<u4")[::2]
            df += np.bincount(held, minlength=size)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"word": pa.array(some, pa.int64()), "df": pa.array(df[some])})
    total = np.zeros(size, np.int64)
    for r in counted.select("counts").mapInArrow(run, "word long, df long").groupBy("word").agg(F.sum("df").alias("df")).collect():
        total[r["word"]] = r["df"]
    return total


def classes(counted: DataFrame, documents: int, terms: int, top: int) -> DataFrame:
    """One row per class (counts, m) with its ``top`` smallest member ids (null ids last)."""
    length = F.lit(50) + F.expr(f"(50L * n * {documents}L) div {terms}L")
    rows = counted.where(F.octet_length("counts") > 0).select("doc_id", "counts", length.alias("m"))
    keyed = rows.withColumn("h", F.xxhash64("counts", "m"))
    same = ["h", "m", "counts"]  # sorted by the hash; equal hashes are verified on the counts
    first = keyed.withColumn("_k", F.row_number().over(Window.partitionBy(*same).orderBy(F.col("doc_id").asc_nulls_last()))).where(F.col("_k") <= top)
    return first.groupBy(*same).agg(F.sort_array(F.collect_list(F.struct(F.col("_k").alias("k"), "doc_id"))).alias("members")).select("counts", "m", F.col("members.doc_id").alias("members"))


def _best(best: tuple[np.ndarray, ...], top: int, items: int) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
    """The ``top`` first of each item by (score descending, known id, id), and each item's score to reach."""
    item, score, late, doc = best
    order = np.lexsort((doc, late, -score, item))
    item = item[order]
    place = np.arange(len(item)) - np.searchsorted(item, item, "left")
    kept = order[place < top]
    bar = np.ones(items, np.int64)
    last = np.flatnonzero(place == top - 1)
    bar[item[last]] = score[order[last]]
    return (best[0][kept], score[kept], late[kept], doc[kept]), bar


def _scorer(weight: np.ndarray, holders: list[np.ndarray], ids: list[int | None], top: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Class rows to the task's ``top`` best (item_id, doc_id, score) per item; ``holders[w]`` are word w's items."""
    first = np.concatenate(([0], np.cumsum([len(h) for h in holders]))).astype(np.int64)
    flat = np.concatenate(holders) if holders else np.zeros(0, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = len(ids)
        best = tuple(np.zeros(0, np.int64) for _ in range(4))
        bar = np.ones(items, np.int64)
        for batch in batches:
            counts = [np.frombuffer(c, "<u4").reshape(-1, 2).astype(np.int64) for c in batch.column("counts").to_pylist()]
            members = batch.column("members").to_pylist()
            m = batch.column("m").to_numpy()
            work = np.cumsum([int((first[c[:, 0] + 1] - first[c[:, 0]]).sum()) for c in counts])
            lo = 0
            while lo < len(counts):  # rows whose words stand in about PAIRS items
                hi = max(lo + 1, int(np.searchsorted(work, (work[lo - 1] if lo else 0) + PAIRS, "right")))
                hi = min(hi, lo + max(1, PAIRS // items))
                some = np.concatenate(counts[lo:hi])
                row = np.repeat(np.arange(hi - lo), [len(c) for c in counts[lo:hi]])
                word, tf = some[:, 0], some[:, 1]
                part = weight[word] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[lo:hi][row]))
                n = first[word + 1] - first[word]
                at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[word], n)
                score = np.zeros((hi - lo) * items, np.int64)
                np.add.at(score, np.repeat(row, n) * items + flat[at], np.repeat(part, n))
                good = np.flatnonzero(score.reshape(-1, items) >= bar)
                size = np.array([len(x) for x in members[lo:hi]])
                own = size[good // items]
                docs = [x for g in (good // items).tolist() for x in members[lo + g]]
                new = (np.repeat(good % items, own), np.repeat(score[good], own), np.array([d is None for d in docs], np.int64), np.array([0 if d is None else d for d in docs], np.int64))
                best, bar = _best(tuple(np.concatenate(x) for x in zip(best, new)), top, items)
                lo = hi
        item, score, late, doc = best
        if len(item):
            yield pa.RecordBatch.from_pydict({"item_id": pa.array([ids[i] for i in item], pa.int64()), "doc_id": pa.array(doc, pa.int64(), mask=late.astype(bool)), "score": pa.array(score)})
    return run


def rank(docs: DataFrame, items: DataFrame, top: int = 50, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per item its ``top`` best documents: item_id, rank (from 1), doc_id, score, by score, then doc_id.

    Words, weights and scores are those of the contract (see README). Null text: no word. Rows that
    repeat a doc_id are documents of their own; null ids come last among equal scores; item rows of one
    id (null is one) are one item. An item without a scoring document has no row; empty tables give
    none. Other columns are ignored."""
    spark: SparkSession = docs.sparkSession
    out = spark.createDataFrame([], "item_id long, doc_id long, score long")
    for block in item_blocks(items, item_col, item_text):
        words = sorted(set().union(*(w for _, w in block)))
        if not words:
            continue
        number = {w: i for i, w in enumerate(words)}
        counted = persisted(word_counts(docs, words, id_col, text_col), "counts")
        size = counted.agg(F.count(F.when(F.col("n") > 0, 1)).alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("l")).first()
        documents, terms = size["n"], size["l"]
        if not documents:
            break
        df = document_frequency(counted, len(words)).tolist()
        weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * d + 1))) for d in df], np.int64)
        held: list[list[int]] = [[] for _ in words]
        for i, (_, own) in enumerate(block):
            for w in own:
                held[number[w]].append(i)
        score = _scorer(weight, [np.array(h, np.int64) for h in held], [i for i, _ in block], top)
        out = out.unionByName(classes(counted, documents, terms, top).mapInArrow(score, "item_id long, doc_id long, score long"))
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")
