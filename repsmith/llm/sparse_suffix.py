"""Repeated passages by word windows, found through a sparse choice of positions.

A passage of LEAST words that stands in two places holds the same minimiser: of its first
WINDOW GRAM-word hashes the smallest one's position, from which at least RIGHT words are
shared. A first pass counts the hashes of these RIGHT words. A second one keeps, where such a
start is found more than once, the hash of every LEAST-word window that selects it (a fixed
map lets a few more through). The windows are range-partitioned and sorted by (hash, doc_id,
position), so equal windows are neighbours, whatever stands around them; the order splits a
hot passage over many partitions. Each window is paired with its predecessor and, if
it is its document's first of the run, with the first of all; a periodic run is thus followed
by its period, on one diagonal. The pairs are merged by diagonal, and each is extended left and
right on the words themselves. Spans of LEAST words or more are reported for the later (doc_id,
position) of the two, so the spans cover every window that has an equal one before it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repsmith.llm._common import marked, persisted
from repsmith.llm._text import SPACES, Prefix, Words, mix, sequences, slices

LEAST, GRAM, WINDOW = 50, 4, 16
RIGHT = LEAST - WINDOW + 1
#: Words beyond the outermost common windows that a match is followed.
MARGIN = WINDOW + GRAM

WINDOWS = "b0 long, doc_id long, pos long, keys array<long>"
PAIR = "kind int, part int, b0 long, doc_id long, pos long, other long, other_pos long"


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per minimiser the hash of the RIGHT words from it, the first window that selects it and the
    hashes of that window and those after it that select it too."""
    schema = pa.schema([(c, pa.int64()) for c in ("b0", "doc_id", "pos")] + [("keys", pa.list_(pa.int64()))])
    for batch in batches:
        for lo, _, data, offsets in slices(batch, "text"):
            words = Words(data, offsets, SPACES)
            row = words.rows()
            starts = np.flatnonzero(row[:-LEAST + 1] == row[LEAST - 1:])
            if not len(starts):
                continue
            views = np.lib.stride_tricks.sliding_window_view(sequences(words.hash, GRAM), WINDOW)
            picks = []
            for at in range(0, len(starts), 1 << 16):
                some = starts[at:at + (1 << 16)]
                picks.append(some + views[some].argmin(axis=1))
            pick = np.concatenate(picks)
            opens = np.flatnonzero(np.concatenate(([True], pick[1:] != pick[:-1])))
            p, first = pick[opens], starts[opens]
            of = Prefix(mix(words.hash))
            b0 = of(p, p + RIGHT)
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)[lo + row[p]]
            keys = pa.ListArray.from_arrays(pa.array(np.append(opens, len(starts)), pa.int32()), pa.array(of(starts, starts + LEAST).view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(b0.view(np.int64)), pa.array(ids, pa.int64()), pa.array(first - words.bounds[row[p]], pa.int64()), keys], schema=schema)


def _starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for out in _windows(batches):
        yield out.select(["b0"])


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Kind 0: a window and its predecessor or, where that is in another document, its run's
    first, in this partition. Kind 1: the partition's first window. Kind 2: its last run's first (doc_id, pos) and last (other, other_pos)."""
    schema = pa.schema([("kind", pa.int32()), ("part", pa.int32())] + [(c, pa.int64()) for c in ("b0", "doc_id", "pos", "other", "other_pos")])
    part = TaskContext.get().partitionId()

    def rows(kind: int, *columns: np.ndarray) -> pa.RecordBatch:
        n = len(columns[0])
        return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int32)), pa.array(np.full(n, part, np.int32)), *map(pa.array, columns)], schema=schema)

    last = hub = None
    for batch in batches:
        if not batch.num_rows:
            continue
        b, d, p = (batch.column(c).to_numpy() for c in ("b0", "doc_id", "pos"))
        if last is None:
            yield rows(1, b[:1], d[:1], p[:1], d[:1], p[:1])
            last = hub = (b[0], d[0], p[0])
        prev = [np.concatenate(([x], y[:-1])) for x, y in zip(last, (b, d, p))]
        starts = b != prev[0]
        at = np.maximum.accumulate(np.where(starts, np.arange(len(b)), -1))
        first_d, first_p = np.where(at < 0, hub[1], d[at]), np.where(at < 0, hub[2], p[at])
        for od, op, extra in ((prev[1], prev[2], True), (first_d, first_p, (d != prev[1]) & ((first_d != prev[1]) | (first_p != prev[2])))):
            take = ~starts & extra & ((od != d) | (op != p))
            if take.any():
                yield rows(0, b[take], d[take], p[take], od[take], op[take])
        last, hub = (b[-1], d[-1], p[-1]), (b[-1], first_d[-1], first_p[-1])
    if last is not None:
        yield rows(2, *[np.array([x], np.int64) for x in (hub[0], hub[1], hub[2], last[1], last[2])])


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("first", pa.int64()), ("until", pa.int64()), ("text_hash", pa.int64()), ("words", pa.binary())])
    known: tuple = (None, None, None)
    for batch in batches:
        ids, first, until, hashes = (batch.column(c).to_pylist() for c in ("doc_id", "first", "until", "text_hash"))
        out = []
        for i in range(batch.num_rows):
            if known[:2] != (ids[i], hashes[i]):
                parts = [Words(data, offsets, SPACES).hash for _, _, data, offsets in slices(batch.slice(i, 1), "text")]
                known = (ids[i], hashes[i], (parts[0] >> np.uint64(32)).astype(np.uint32))
            out.append(known[2][first[i]:until[i]].tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("doc_id", "first", "until", "text_hash")] + [pa.array(out, pa.binary())], schema=schema)


def _extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Aligns both segments on their diagonal and returns the runs of LEAST equal words or more."""
    names = ("doc_id", "text_hash", "start_word", "n_words", "source_id", "source_start")
    schema = pa.schema([(c, pa.int64()) for c in names])
    for batch in batches:
        found = []
        ids, hashes, sources, firsts, others = (batch.column(c).to_pylist() for c in ("doc_id", "text_hash", "other", "first", "other_first"))
        for i, (x, y) in enumerate(zip(batch.column("words"), batch.column("other_words"))):
            x, y = np.frombuffer(x.as_buffer(), np.uint32), np.frombuffer(y.as_buffer(), np.uint32)
            n = min(len(x), len(y))
            edge = np.diff(np.concatenate(([0], (x[:n] == y[:n]).astype(np.int8), [0])))
            for s, e in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)):
                if e - s >= LEAST:
                    found.append((ids[i], hashes[i], firsts[i] + s, e - s, sources[i], others[i] + s))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], schema=schema)


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans that repeat earlier text: doc_id, text_hash, start_word, n_words, source_id, source_start.

    Words are separated by ASCII white space and compared with A-Z in lower case. "Earlier"
    is the smaller (doc_id, position), also inside one document; several spans may overlap, and
    each comes with the earliest source found for it.
    Rows without doc_id or text take no part. Rows that repeat a doc_id count as one document
    (equal rows are not compared with each other); ``text_hash`` (xxhash64) tells differing
    texts of one id apart. Fewer than LEAST words or an empty table give no span."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("doc_id is not null and text is not null")
    often = docs.mapInArrow(_starts, "b0 long").groupBy("b0").count().where("count > 1")
    kept = marked(docs.mapInArrow(_windows, WINDOWS), [F.col("b0")], often, [F.col("b0")]).where("_maybe")
    # Written, as the range partitioning reads its input twice.
    kept = persisted(kept.select("doc_id", "pos", "keys"), "windows").select("doc_id", "pos", F.posexplode("keys").alias("_i", "b0"))
    windows = kept.select("b0", "doc_id", (F.col("pos") + F.col("_i")).alias("pos"))
    ordered = windows.repartitionByRange("b0", "doc_id", "pos").sortWithinPartitions("b0", "doc_id", "pos")
    near = persisted(ordered.mapInArrow(_neighbours, PAIR), "neighbours")

    # Two rows for each partition: the run that a partition starts with may have begun before it.
    ends = near.where("kind > 0").groupBy("part").agg(
        *[F.max(F.when(F.col("kind") == k, F.struct("b0", "doc_id", "pos", "other", "other_pos"))).alias(n) for k, n in ((1, "head"), (2, "tail"))])
    across = ends.withColumn("prev", F.lag("tail").over(Window.orderBy("part"))).where("prev.b0 = head.b0")
    seams = across.select(F.col("head.doc_id").alias("doc_id"), F.col("head.pos").alias("pos"),
                          F.explode(F.array(F.struct(F.col("prev.doc_id").alias("other"), F.col("prev.pos").alias("other_pos")), F.struct("prev.other", "prev.other_pos"))).alias("o")).select("doc_id", "pos", "o.*")
    pairs = near.where("kind = 0").select("doc_id", "pos", "other", "other_pos").unionByName(seams)
    swap = (F.col("doc_id") < F.col("other")) | ((F.col("doc_id") == F.col("other")) & (F.col("pos") < F.col("other_pos")))
    pick = lambda a, b: F.when(swap, F.col(b)).otherwise(F.col(a))
    turned = pairs.select(pick("doc_id", "other").alias("doc_id"), pick("pos", "other_pos").alias("pos"), pick("other", "doc_id").alias("other"), pick("other_pos", "pos").alias("other_pos"))
    merged = (turned.withColumn("shift", F.col("pos") - F.col("other_pos")).where("doc_id <> other or shift <> 0")
              .groupBy("doc_id", "other", "shift").agg(F.min("pos").alias("lo"), F.max("pos").alias("hi")))
    reach = F.least(F.lit(MARGIN), F.col("lo"), F.col("lo") - F.col("shift"))
    merged = persisted(merged.withColumn("first", F.col("lo") - reach).withColumn("until", F.col("hi") + LEAST + MARGIN)
                       .select("doc_id", "other", "first", "until", (F.col("first") - F.col("shift")).alias("other_first"), (F.col("until") - F.col("shift")).alias("other_until")), "matches")

    wanted = merged.select("doc_id", "first", "until").unionByName(merged.select(F.col("other").alias("doc_id"), F.col("other_first").alias("first"), F.col("other_until").alias("until"))).distinct()
    # Only texts that a fixed map of the wanted ids lets through are shuffled; the sort-merge join holds at any size.
    likely = marked(docs, [F.col("doc_id")], wanted, [F.col("doc_id")]).where("_maybe").drop("_maybe")
    texts = likely.join(wanted.hint("merge"), "doc_id").withColumn("text_hash", F.xxhash64("text"))
    cut = persisted(texts.mapInArrow(_segments, "doc_id long, first long, until long, text_hash long, words binary"), "segments")
    other = cut.select(F.col("doc_id").alias("other"), F.col("first").alias("other_first"), F.col("until").alias("other_until"), F.col("words").alias("other_words"))
    both = merged.join(other, ["other", "other_first", "other_until"]).join(cut, ["doc_id", "first", "until"])
    spans = both.select("doc_id", "text_hash", "other", "first", "other_first", "words", "other_words").mapInArrow(
        _extend, "doc_id long, text_hash long, start_word long, n_words long, source_id long, source_start long")
    source = F.min(F.struct("source_id", "source_start")).alias("s")
    return spans.groupBy("doc_id", "text_hash", "start_word", "n_words").agg(source).select("doc_id", "text_hash", "start_word", "n_words", "s.source_id", "s.source_start")


def _cut_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, stay = [], []
        for text, spans in zip(batch.column("_text").to_pylist(), batch.column("_spans").to_pylist()):
            if spans:
                raw = text.encode()
                words = Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), SPACES)
                pieces, at = [], 0
                for lo, hi in [*sorted((x["start_word"], x["start_word"] + x["n_words"]) for x in spans), (len(words.starts),) * 2]:
                    if lo > at:
                        pieces.append(raw[words.starts[at]:words.ends[lo - 1]])
                    at = max(at, hi)
                text = b"\n".join(pieces).decode()
            texts.append(text)
            stay.append(bool(text) or not spans)
        rest = [n for n in batch.schema.names if n not in ("_text", "_spans")]
        out = pa.RecordBatch.from_arrays([*[batch.column(n) for n in rest], pa.array(texts, pa.string())], names=[*rest, "_text"])
        yield out.filter(pa.array(stay, pa.bool_()))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every repeated passage cut from its later places (what is left is joined by a
    line feed); rows of which no word is left are dropped. Other columns pass through unchanged."""
    spans = repeated_passages(docs, id_col, text_col)
    cuts = persisted(spans.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
                     .agg(F.collect_set(F.struct("start_word", "n_words")).alias("_spans")), "cuts")
    names = [f"_c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    of = dict(zip(docs.columns, names))
    text = F.col(of[text_col]).cast("string")
    # Rows without a cut pass by: only those that may have one are shuffled.
    key = [F.col(of[id_col]).cast("long"), F.xxhash64(text)]
    sorted_out = marked(plain, key, cuts, [F.col("_id"), F.col("_hash")])
    found = sorted_out.where("_maybe").join(cuts.hint("merge"), (key[0] == F.col("_id")) & (key[1] == F.col("_hash")), "left")
    rest = [n for n in names if n != of[text_col]]
    schema = ", ".join([*[f"{n} {plain.schema[n].dataType.simpleString()}" for n in rest], "_text string"])
    cut = found.select(*rest, text.alias("_text"), "_spans").mapInArrow(_cut_text, schema)
    out = sorted_out.where("not _maybe").select(*rest, text.alias("_text")).unionByName(cut)
    return out.select(*[F.col("_text" if c == text_col else of[c]).alias(c) for c in docs.columns])
