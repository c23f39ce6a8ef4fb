"""Token ids of a corpus as files of independently coded, checksummed blocks.

Documents are put in order of their ids by a range shuffle; each task encodes its texts and writes
segments of at most SEGMENT_IDS ids. A segment is a file of its own:

    magic, version, sizes          struct HEADER, little-endian
    checksum of what follows       crc32 of the header's sizes and the index, before packing
    index                          zlib: per document its id, known or null, ids in this segment, and
                                   whether it goes on in the next one
    table                          per block: ids, payload words, crc32 of the payload, crc32 of the ids
    payloads                       ``id_mixing``, every block from scratch
    zero byte                      end mark

Spark's text sink writes and commits the files, the zero byte being its line separator, so any file
system works and a lost task is written again. Any block can be decoded alone (``read_block``).
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from repsmith.llm import id_mixing
from repsmith.llm._common import persisted, scratch
from repsmith.llm._text import slices
from repsmith.llm._tokens import kept_encoder

SEGMENT_BLOCKS = 4096
SEGMENT_IDS = SEGMENT_BLOCKS * id_mixing.BLOCK_IDS
#: Fixed by the format.
MAGIC, VERSION, END = b"IDSEG", 2, b"\0"
HEADER = struct.Struct("<5sBBBIQQIIII")  # magic, version, bits, -, part, first id and first document in the part, documents, blocks, block ids, packed index
ENTRY = np.dtype([("doc", "<i8"), ("known", "u1"), ("more", "u1"), ("ids", "<u8")])
BLOCK = np.dtype([("ids", "<u4"), ("words", "<u4"), ("payload_crc", "<u4"), ("ids_crc", "<u4")])


class Segment(NamedTuple):
    part: int
    first_id: int
    first_doc: int
    entries: np.ndarray
    blocks: np.ndarray
    block_ids: int
    bits: int
    payloads: list[bytes]


def write_segment(part: int, first_id: int, first_doc: int, entries: np.ndarray, ids: np.ndarray, block: int = id_mixing.BLOCK_IDS) -> bytes:
    """A segment without its end mark; ``entries`` (ENTRY) name the documents of ``ids`` in order."""
    bits = max(8, int(ids.max()).bit_length() if len(ids) else 0)
    payloads = id_mixing.encode(ids, bits, block)
    plain = ids.astype("<u4")
    table = np.array([(len(plain[i * block:(i + 1) * block]), len(p) // 4, zlib.crc32(p), zlib.crc32(plain[i * block:(i + 1) * block].tobytes())) for i, p in enumerate(payloads)], BLOCK)
    index = entries.astype(ENTRY).tobytes()
    packed = zlib.compress(index, 6)
    head = HEADER.pack(MAGIC, VERSION, bits, 0, part, first_id, first_doc, len(entries), len(payloads), block, len(packed))
    check = zlib.crc32(table.tobytes(), zlib.crc32(index, zlib.crc32(head)))
    return b"".join([head, struct.pack("<I", check), packed, table.tobytes(), *payloads])


def parse_segment(raw: bytes) -> Segment:
    """The parts of a segment file; raises ValueError where header, index, table or sizes are damaged."""
    if len(raw) < HEADER.size + 5 or raw[:5] != MAGIC or raw[5] != VERSION:
        raise ValueError("not an id segment")
    _, _, bits, _, part, first_id, first_doc, documents, blocks, block, packed = HEADER.unpack_from(raw)
    at = HEADER.size + 4
    try:
        index = zlib.decompress(raw[at:at + packed])
    except zlib.error as e:
        raise ValueError("id segment: damaged index") from e
    at += packed
    table = raw[at:at + blocks * BLOCK.itemsize]
    if zlib.crc32(table, zlib.crc32(index, zlib.crc32(raw[:HEADER.size]))) != struct.unpack_from("<I", raw, HEADER.size)[0] or len(index) != documents * ENTRY.itemsize:
        raise ValueError("id segment: damaged index")
    facts = np.frombuffer(table, BLOCK)
    ends = at + len(table) + 4 * np.cumsum(facts["words"].astype(np.int64))
    if len(raw) != (int(ends[-1]) if blocks else at + len(table)) + len(END) or raw[-1:] != END:
        raise ValueError("id segment: wrong length")
    payloads = [raw[e - 4 * int(w):e] for e, w in zip(ends.tolist(), facts["words"].tolist())]
    return Segment(part, first_id, first_doc, np.frombuffer(index, ENTRY), facts, block, bits, payloads)


def segment_ids(s: Segment, which: list[int] | None = None) -> list[np.ndarray]:
    """Ids of the given blocks (all by default); raises ValueError where a checksum is wrong."""
    which = list(range(len(s.payloads))) if which is None else which
    for i in which:
        if zlib.crc32(s.payloads[i]) != s.blocks["payload_crc"][i]:
            raise ValueError(f"id segment: block {i} is damaged")
    out = id_mixing.decode([s.payloads[i] for i in which], [int(s.blocks["ids"][i]) for i in which], s.bits, s.block_ids)
    for i, ids in zip(which, out):
        if zlib.crc32(ids.tobytes()) != s.blocks["ids_crc"][i]:
            raise ValueError(f"id segment: block {i} decodes to other ids")
    return out


def read_block(raw: bytes, block: int) -> np.ndarray:
    """Ids of one block of a segment file; no other block is decoded."""
    return segment_ids(parse_segment(raw), [block])[0]


def _writer(run_id: str, tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        encode = kept_encoder(run_id, tokenizer, end_id)
        part = TaskContext.get().partitionId()
        ids: list[np.ndarray] = []
        docs: list[np.ndarray] = []
        held = first_id = first_doc = 0

        def cut(limit: int) -> Iterator[pa.RecordBatch]:
            """Segments while more than ``limit`` ids are held."""
            nonlocal ids, docs, held, first_id, first_doc
            while held > limit:
                flat, entries = np.concatenate(ids), np.concatenate(docs)
                n = min(held, SEGMENT_IDS)
                ends = np.cumsum(entries["ids"].astype(np.int64))
                last = int(np.searchsorted(ends, n, "left"))  # the document that the cut is in, or ends with
                own, rest = entries[:last + 1].copy(), entries[last:].copy()
                over = int(ends[last]) - n
                own["ids"][-1] -= over
                own["more"][-1] = over > 0
                rest["ids"][0] = over
                segment = write_segment(part, first_id, first_doc, own, flat[:n])
                first_id, first_doc, held = first_id + n, first_doc + last + (over == 0), held - n
                ids, docs = [flat[n:]], [rest if over else rest[1:]]
                yield pa.RecordBatch.from_pydict({"segment": pa.array([segment], pa.binary())})

        for batch in batches:
            for lo, hi, data, at in slices(batch, "text"):
                some, n = encode(data, at)
                key = batch.column("doc_id").slice(lo, hi - lo)
                entry = np.zeros(hi - lo, ENTRY)
                entry["doc"], entry["known"], entry["ids"] = key.fill_null(0).to_numpy(), np.asarray(key.is_valid()), n
                ids.append(some)
                docs.append(entry)
                held += len(some)
                yield from cut(SEGMENT_IDS - 1)
        yield from cut(0)
    return run


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Segment files of the documents' ids, each document's followed by ``end_id``, in ascending id order.

    Null ids come first, rows of one id in the order of a hash of their texts (it is part of the range key,
    so a frequent id is spread); null text: the end id alone. Other columns are ignored."""
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("_tie", F.xxhash64("text"))
    ordered = plain.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie").drop("_tie")
    segments = ordered.mapInArrow(_writer(path, tokenizer, end_id), "segment binary")
    segments.select(F.col("segment").cast("string").alias("value")).write.option("lineSep", END.decode()).option("maxRecordsPerFile", 1).text(path)


def _joined(parts: list[tuple[int, int]]) -> int:
    """crc32 of a sequence from (bytes, crc32) of its pieces: crc32 is linear, so zeros carry the first part on."""
    total = 0
    for size, crc in parts:
        carried, none = total, 0
        while size > 0:
            zeros = bytes(min(size, 1 << 20))
            carried, none = zlib.crc32(zeros, carried), zlib.crc32(zeros, none)
            size -= len(zeros)
        total = carried ^ none ^ crc
    return total


def _entries(batches: Iterator[pa.RecordBatch], with_ids: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for raw in batch.column("content"):
            s = parse_segment(raw.as_py())
            ids = np.concatenate([*segment_ids(s), np.zeros(0, "<u4")]).astype("<u4")
            n = s.entries["ids"].astype(np.int64)
            ends = np.cumsum(n)
            if len(ids) != (ends[-1] if len(n) else 0):
                raise ValueError("id segment: index and blocks differ")
            flat = memoryview(ids.tobytes())
            columns = {"part": pa.array(np.full(len(n), s.part, np.int32)), "at": pa.array(s.first_id + ends - n), "doc_no": pa.array(s.first_doc + np.arange(len(n))),
                       "doc_id": pa.array(s.entries["doc"], mask=s.entries["known"] == 0), "more": pa.array(s.entries["more"] == 1), "n": pa.array(n),
                       "crc": pa.array([zlib.crc32(flat[4 * a:4 * b]) for a, b in zip((ends - n).tolist(), ends.tolist())], pa.int64())}
            if with_ids:
                columns["ids"] = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(ids.astype(np.int64)))
            yield pa.RecordBatch.from_pydict(columns)


def read_entries(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Per document and segment: part, at (ids of the part before it), doc_no (in the part), doc_id, more
    (it goes on in the next segment), n, crc (crc32 of these ids as little-endian unsigned 32-bit) and, on
    request, ids. Every block is decoded and its checksums are verified."""
    schema = "part int, at long, doc_no long, doc_id long, more boolean, n long, crc long" + (", ids array<long>" if with_ids else "")
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(lambda batches: _entries(batches, with_ids), schema)


def documents_of(entries: DataFrame) -> DataFrame:
    """Per document doc_id, start (ids of all documents before it), n_tokens, ids_crc32 from ``entries``,
    a written table. Only documents cut by a segment's end are brought together."""
    sizes = entries.groupBy("part").agg(F.sum("n").alias("size"))  # a row per task that wrote
    before = sizes.select(F.col("part").alias("_part"), F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    cut = entries.where("more").select(F.col("part").alias("_p"), F.col("doc_no").alias("_d")).distinct()
    hit = (F.col("part") == F.col("_p")) & (F.col("doc_no") == F.col("_d"))
    whole = entries.where("not more").join(cut, hit, "left_anti").select("part", "at", "doc_id", "n", "crc")
    joined = F.udf(lambda parts: _joined([(4 * p["n"], p["crc"]) for p in parts]), "long")
    several = (entries.join(cut, hit, "left_semi").groupBy("part", "doc_no", "doc_id")
               .agg(F.min("at").alias("at"), F.sum("n").alias("n"), F.sort_array(F.collect_list(F.struct("at", "n", "crc"))).alias("parts"))  # a document's own segments
               .select("part", "at", "doc_id", "n", joined("parts").alias("crc")))
    return whole.unionByName(several).join(before, F.col("part") == F.col("_part")).select("doc_id", (F.col("at") + F.col("_before")).alias("start"), F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"))


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the ids' files, reads them back and returns one row per document from what was read.
    An empty table gives no rows."""
    spark = docs.sparkSession
    path = scratch(spark, "ids")
    write_ids(docs, path, tokenizer, end_id, id_col, text_col)
    return documents_of(persisted(read_entries(spark, path), "entries"))
