"""Best-two-fit packing of tokenised documents into fixed-length sequences.

Only the number of pieces of each length matters to the packing, so the plan is made from
a histogram of at most ``capacity`` lengths, whatever the corpus: a bin is filled greedily
with the longest lengths that fit; then its smallest piece gives way to the two unpacked
pieces that fill the widened gap more tightly, if there are such. The pattern is used as
often as the counts allow, which uses up a length, so there are few patterns. Spark numbers
the pieces within each length (hot lengths are spread), and a piece's number tells its
sequence and offset.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repsmith.llm._common import group_rank, persisted, released
from repsmith.llm._text import slices
from repsmith.llm._tokens import encoder

CAPACITY, END_ID = 2048, 0


def _pieces(tokenizer: str, capacity: int, with_ids: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, END_ID)
        for batch in batches:
            for lo, hi, data, at in slices(batch, "text"):
                ids, n = encode(data, at)
                parts = -(-n // capacity)  # a document has its end id at least
                row = np.repeat(np.arange(hi - lo), parts)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
                start = piece * capacity
                length = np.minimum(n[row] - start, capacity)
                ends = np.cumsum(length)  # pieces stand one after the other, as their documents do
                flat = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(flat[4 * (e - k):4 * e]) for e, k in zip(ends.tolist(), length.tolist())]
                columns = {"doc_id": batch.column("doc_id").slice(lo, hi - lo).take(pa.array(row)), "piece": pa.array(piece.astype(np.int32)), "start": pa.array(start), "length": pa.array(length), "ids_crc32": pa.array(crc, pa.int64())}
                if with_ids:
                    columns["ids"] = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_pydict(columns)
    return run


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece of at most ``capacity`` tokens: doc_id, piece, start, length, ids_crc32 and, on
    request, ids. A document's ids are its text's followed by END_ID; null or empty text: END_ID alone."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(released(_pieces(tokenizer, capacity, with_ids)), schema)


def _greedy(gap: int, left: Counter, lengths: list[int]) -> tuple[list[int], int]:
    """The longest available lengths that fit, one after the other; ``left`` is used up accordingly."""
    taken = []
    at = bisect_right(lengths, gap) - 1
    while at >= 0:
        length = lengths[at]
        n = min(left[length], gap // length)
        taken += [length] * n
        left[length] -= n
        gap -= n * length
        at = min(at - 1, bisect_right(lengths, gap) - 1)
    return taken, gap


def _tightest_pair(over: int, most: int, left: Counter, lengths: list[int]) -> tuple[int, int] | None:
    """Two available lengths with the largest sum that is above ``over`` and at most ``most``."""
    best, lo, hi = None, 0, bisect_right(lengths, most) - 1
    while lo <= hi:
        x, y = lengths[lo], lengths[hi]
        if not left[x] or (lo == hi and left[x] < 2):
            lo += 1
        elif not left[y] or x + y > most:
            hi -= 1
        else:
            if x + y > over:
                best, over = (x, y), x + y
            lo += 1
    return best


def packing_plan(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in a bin, number of such bins) covering the histogram exactly."""
    left = Counter({k: v for k, v in histogram.items() if v > 0})
    plan = []
    while left:
        lengths = sorted(left)
        trial = left.copy()
        items, gap = _greedy(capacity, trial, lengths)
        if gap and items:
            smallest = items[-1]
            pair = _tightest_pair(smallest, smallest + gap, trial, lengths)
            if pair:
                items = sorted([*items[:-1], *pair], reverse=True)
        use = Counter(items)
        times = min(left[k] // n for k, n in use.items())
        plan.append((tuple(items), times))
        for k, n in use.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
    return plan


def _places(plan: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length, ascending runs of numbers: first number, first sequence, pieces per sequence, offset."""
    taken: Counter = Counter()
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    sequence = 0
    for items, times in plan:
        offset = 0
        for length, n in Counter(items).items():
            runs.setdefault(length, []).append((taken[length], sequence, n, offset))
            taken[length] += n * times
            offset += n * length
        sequence += times
    return {k: tuple(np.array(c, np.int64) for c in zip(*v)) for k, v in runs.items()}


def _place(places: dict[int, tuple[np.ndarray, ...]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = batch.column("length").to_numpy(), batch.column("_number").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for value in np.unique(length):
                at = length == value
                first, base, n, start = places[int(value)]
                run_ = np.searchsorted(first, number[at], "right") - 1
                i = number[at] - first[run_]
                sequence[at], offset[at] = base[run_] + i // n[run_], start[run_] + i % n[run_] * value
            yield pa.RecordBatch.from_arrays([*[c for c, name in zip(batch.columns, batch.schema.names) if name != "_number"], pa.array(sequence), pa.array(offset)],
                                             names=[*[n for n in batch.schema.names if n != "_number"], "sequence_id", "offset"])
    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (doc_id, piece, length of 1 to ``capacity``, any other columns) with sequence_id and
    offset: the pieces of a sequence fill it from 0 without gaps. Pass a written table: it is read
    twice. Repeated rows are packed one by one; no rows give no sequences."""
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `capacity` rows
    places = _places(packing_plan(counts, capacity))
    numbered = group_rank(pieces, ["length"], ["doc_id", "piece"], [F.col("doc_id"), F.col("piece"), F.spark_partition_id()], "_number")
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema], "sequence_id long, offset long"])
    return numbered.select(*pieces.columns, "_number").mapInArrow(_place(places), schema)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenise, cut only what is longer than a sequence, and pack. Further columns of ``docs`` are ignored."""
    return pack(persisted(token_pieces(docs, tokenizer, capacity, with_ids, id_col, text_col), "pieces"), capacity)
