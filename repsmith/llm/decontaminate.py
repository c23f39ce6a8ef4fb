"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Test items are taken in blocks of bounded size (any number of blocks, one pass over the
corpus each). A copy of an m-word item with k edits, k the most that the similarity allows,
keeps k + 1 runs of equal words at most, one of which has (m - k) / (k + 1) words or more:
that is the length of the item's seeds, and all its n-grams of that length are seeds, however
frequent. A pass marks, in every text, the words of the block's vocabulary and finds the
seeds. Around each seed's diagonal the words that the item and the text have in common are
counted, which bounds the similarity from above; where that is enough, both are aligned on
words. The similarity is the share of the item's words that the best local alignment matches
with equal words in the same order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repsmith.llm._common import persisted
from repsmith.llm._text import NON_WORD, Words, sequences, slices

SIMILARITY, BLOCK_BYTES = 0.8, 16 << 20


class Items:
    """One block of test items, as sent to the tasks: at most about BLOCK_BYTES of text."""

    def __init__(self, rows: list[tuple[int, str]], least: float = SIMILARITY):
        texts = pa.RecordBatch.from_pydict({"text": pa.array([t for _, t in rows], pa.string())})
        self.ids, self.words = [i for i, _ in rows], []
        for _, _, data, offsets in slices(texts, "text"):
            w = Words(data, offsets, NON_WORD)
            self.words += [w.hash[a:b] for a, b in zip(w.bounds[:-1], w.bounds[1:])]
        self.need = [int(np.ceil(least * len(w) - 1e-9)) for w in self.words]
        self.vocabulary = np.unique(np.concatenate([*self.words, np.zeros(0, np.uint64)]))
        #: Per length the seeds' hashes in order, with item and position.
        self.seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        found: dict[int, list[tuple[np.ndarray, int]]] = {}
        for k, w in enumerate(self.words):
            if len(w):
                n = seed_size(len(w), self.need[k])
                found.setdefault(n, []).append((sequences(w, n), k))
        for n, x in found.items():
            hashes = np.concatenate([h for h, _ in x])
            order = np.argsort(hashes, kind="stable")
            self.seeds[n] = hashes[order], np.repeat([k for _, k in x], [len(h) for h, _ in x])[order], np.concatenate([np.arange(len(h)) for h, _ in x])[order]


def seed_size(m: int, need: int) -> int:
    """The longest run of equal words that is left for sure of ``m`` with ``m - need`` edits."""
    return max(1, -(-need // (m - need + 1)))


def smith_waterman(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int, int]:
    """(score, equal words, start, end) of the best local alignment of ``item`` in ``text``: equal
    words +1, unequal words and gaps -1. Start and equal words are carried along with each cell."""
    n = len(text)
    steps = np.arange(n + 1)
    score, origin, equal = np.zeros(n + 1, np.int64), steps, np.zeros(n + 1, np.int64)
    best = (0, 0, 0, 0)
    for word in item:
        same = text == word
        diagonal, above = np.concatenate(([0], score[:-1] + np.where(same, 1, -1))), score - 1
        take = diagonal >= above
        start = np.where(take, np.concatenate(([0], origin[:-1])), origin)
        matched = np.where(take, np.concatenate(([0], equal[:-1] + same)), equal)
        cell = np.maximum(diagonal, above)
        start, matched, cell = np.where(cell > 0, start, steps), np.where(cell > 0, matched, 0), np.maximum(cell, 0)
        # A gap in the item: the best of cell[j'] - (j - j') over j' <= j.
        lead = cell + steps
        reach = np.maximum.accumulate(lead)
        from_ = np.maximum.accumulate(np.where(lead == reach, steps, 0))
        score, origin, equal = reach - steps, start[from_], matched[from_]
        end = int(score.argmax())
        if score[end] > best[0]:
            best = (int(score[end]), int(equal[end]), int(origin[end]), end)
    return best


def _seeds(items: Items, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, item, diagonal as word number) of every seed found, distinct and in order."""
    row = words.rows()
    at = np.minimum(np.searchsorted(items.vocabulary, words.hash), len(items.vocabulary) - 1)
    known = np.concatenate(([0], np.cumsum(items.vocabulary[at] == words.hash)))
    found = []
    for n, (hashes, of, position) in items.seeds.items():
        if len(row) < n:
            continue
        p = np.flatnonzero((known[n:] - known[:-n] == n) & (row[:len(row) - n + 1] == row[n - 1:]))
        h = sequences(words.hash, n)[p]
        lo, hi = np.searchsorted(hashes, h), np.searchsorted(hashes, h, "right")
        many = hi - lo
        seed = np.repeat(lo - np.cumsum(many) + many, many) + np.arange(many.sum())
        p = np.repeat(p, many)
        found.append(np.stack([row[p], of[seed], p - position[seed]]))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    r, k, d = np.concatenate(found, axis=1)
    order = np.lexsort((d, k, r))
    r, k, d = r[order], k[order], d[order]
    new = np.concatenate(([True], (r[1:] != r[:-1]) | (k[1:] != k[:-1]) | (d[1:] != d[:-1])))[:len(r)]
    return r[new], k[new], d[new]


def _aligned(items: Items) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = ("doc_id", "item_id", "similarity", "start_word", "end_word")
    schema = pa.schema(list(zip(names, (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()))))
    own = [np.unique(w, return_counts=True) for w in items.words]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best: dict[tuple[int, int], tuple] = {}
            for lo, _, data, offsets in slices(batch, "text"):
                words = Words(data, offsets, NON_WORD)
                if not len(words.hash) or not len(items.vocabulary):
                    continue
                last, end = None, -1
                for r, k, d in zip(*(x.tolist() for x in _seeds(items, words))):
                    item, first, until = items.words[k], int(words.bounds[r]), int(words.bounds[r + 1])
                    m = len(item)
                    if last == (r, k) and d + 2 * m <= end:  # inside the window around an earlier diagonal
                        continue
                    a, end, last = max(first, d - m), min(until, d + 3 * m), (r, k)
                    text = words.hash[a:end]
                    distinct, counts = own[k]
                    ordered = np.sort(text)
                    common = np.searchsorted(ordered, distinct, "right") - np.searchsorted(ordered, distinct)
                    if np.minimum(common, counts).sum() < items.need[k]:
                        continue
                    _, equal, s, e = smith_waterman(item, text)
                    if equal >= items.need[k] and equal / m > best.get((lo + r, k), (0,))[0]:
                        best[lo + r, k] = (equal / m, a - first + s, a - first + e)
            if best:
                ids = batch.column("doc_id").to_pylist()
                found = [(ids[r], items.ids[k], *v) for (r, k), v in best.items()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), schema.types)], schema=schema)
    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per (doc_id, item_id) with similarity >= ``least``, its best place as word numbers.

    Words are runs of ASCII letters, digits and non-ASCII characters in lower case. Items without
    a word match nothing.
    Null texts match nothing; a null doc_id is reported as null. Rows that repeat a document are
    each reported, repeated items too. Other columns of both tables are ignored."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.lower(F.col(text_col).cast("string")).alias("text"))
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.lower(F.col(item_text).cast("string")).alias("text")).where("text is not null")
    total = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = -(-total // BLOCK_BYTES)
    schema = "doc_id long, item_id long, similarity double, start_word long, end_word long"
    out = spark.createDataFrame([], schema)
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        held = Items([(r["item_id"], r["text"]) for r in own.orderBy("item_id", "text").collect()], least)  # about BLOCK_BYTES
        out = out.unionByName(docs.mapInArrow(_aligned(held), schema))
    return out


def without_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose doc_id is not reported (rows without a doc_id stay)."""
    found = persisted(contaminated(docs, benchmark, id_col=id_col, text_col=text_col).select(F.col("doc_id").alias("_leaked")).distinct(), "leaked")
    return docs.join(found, F.col(id_col).cast("long") == F.col("_leaked"), "left_anti")
