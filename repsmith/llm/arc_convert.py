"""Legacy ARC archives to WARC.

ARC files (version 1 and 2) are read by their version block, their header lines and the
lengths these declare. Each record becomes a WARC/1.1 record: the identifier is derived from
where the record stood, the 14-digit date becomes a timestamp, the type follows from the
record's content, digests are computed. Of HTTP responses with equal payloads of at least
MIN_REVISIT bytes one stays a response and the others become revisits of it.

Archives are segments of bounded size, one file each, with every record a gzip member of its
own (external ARC files may also be plain or one stream). Spark's text sink writes and commits
them, so any file system works and a lost task is written again; it ends each file with one
zero byte, which gzip readers take for padding.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repsmith.llm._common import persisted, scratch

MIN_REVISIT, SEGMENT_BYTES, LEVEL = 100, 8 << 20, 4
DATE = "20240101000000"
#: Fixed by the ARC format: fields of a header line by version.
FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"),
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _member(raw: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def inflate(content: bytes) -> bytes:
    """Whole bytes of a plain or gzipped archive, padding included."""
    return gzip.GzipFile(fileobj=io.BytesIO(content)).read() if content[:2] == b"\x1f\x8b" else content


def _write(segments: DataFrame, path: str) -> None:
    """One file per row of ``segment``."""
    segments.select(F.col("segment").cast("string").alias("value")).write.option("lineSep", "\u0000").option("maxRecordsPerFile", 1).text(path)


def _segments(head: Callable[[int], bytes], records: Callable[[pa.RecordBatch], Iterator[bytes]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows to archives of about SEGMENT_BYTES (a longer record has one of its own), each with a head record."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        size = number = 0

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([b"".join([_member(head(number)), *held])], pa.binary())], names=["segment"])

        for batch in batches:
            for raw in records(batch):
                if held and size + len(raw) > SEGMENT_BYTES:
                    yield done()
                    held, size, number = [], 0, number + 1
                held.append(_member(raw))
                size += len(raw)
        if held:
            yield done()
    return run


# --- ARC ---------------------------------------------------------------------------------------

def arc_version_block(version: int, name: str = "segment.arc") -> bytes:
    body = f"{version} 0 repsmith\n{' '.join(FIELDS[version])}\n\n".encode()
    line = ["0.0.0.0", DATE, "text/plain"] + (["200", "-", "-", "0", name] if version == 2 else []) + [str(len(body))]
    return f"filedesc://{name} {' '.join(line)}\n".encode() + body + b"\n"


def arc_record(version: int, url: str, mime: str, block: bytes, date: str = DATE, ip: str = "0.0.0.0") -> bytes:
    line = [re.sub(r"[\s\x00-\x1f]", lambda m: f"%{ord(m[0]):02X}", url) or "-", ip, date, mime]
    if version == 2:
        line += ["200", "-", "-", "0", "segment.arc"]
    return " ".join([*line, str(len(block))]).encode() + b"\n" + block + b"\n"


def write_pages_as_arc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Each row as an HTTP response in ARC files; partitions with even numbers use version 1, the others 2.
    The row's id goes into the header X-Page-Id (null: none), null html is an empty body."""
    def records(batch: pa.RecordBatch) -> Iterator[bytes]:
        version = 1 + batch.column("part")[0].as_py() % 2 if batch.num_rows else 1
        for page, url, page_html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html"))):
            payload = (page_html or "").encode()
            own = "" if page is None else f"X-Page-Id: {page}\r\n"
            head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{own}Content-Length: {len(payload)}\r\n\r\n"
            yield arc_record(version, url or "-", "text/html", head.encode() + payload)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        version = 1 + TaskContext.get().partitionId() % 2
        yield from _segments(lambda _: arc_version_block(version), records)(batches)

    plain = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"), F.spark_partition_id().alias("part"))
    _write(plain.mapInArrow(run, "segment binary"), path)


def parse_arc(raw: bytes) -> Iterator[dict]:
    """Records of one ARC: offset, the header line's fields by name, block, truncated.

    The version block's own line tells the version by its number of fields; its body's second
    line names the fields of the records. A record whose declared length goes past the end is
    returned with what there is and marked truncated; an unreadable header line raises ValueError."""
    at, fields = 0, FIELDS[1]
    while at < len(raw):
        if raw[at] in b"\r\n\0":  # between records, and the file's padding
            at += 1
            continue
        end = raw.find(b"\n", at)
        line = raw[at:end if end >= 0 else len(raw)].decode("utf-8", "replace").rstrip("\r")
        is_head = line.startswith("filedesc:")
        names = FIELDS[2] if is_head and len(line.split(" ")) >= len(FIELDS[2]) else FIELDS[1] if is_head else fields
        values = line.rsplit(" ", len(names) - 1)
        if len(values) != len(names) or not values[-1].isdigit() or end < 0:
            raise ValueError(f"no ARC header line at byte {at}: {line[:200]!r}")
        length = int(values[-1])
        block = raw[end + 1:end + 1 + length]
        if is_head:
            lines = block.decode("utf-8", "replace").splitlines()
            if len(lines) > 1 and lines[1].startswith("URL "):
                fields = tuple(lines[1].split(" "))
        yield {"offset": at, **dict(zip(names, values)), "block": block, "truncated": len(block) < length}
        at = end + 1 + length


def _split_http(block: bytes) -> tuple[bytes, bytes]:
    """(head with its blank line, payload) of an HTTP message; a message without the blank line is all head."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    cuts = [i + n for sep, n in ((b"\r\n\r\n", 4), (b"\n\n", 2)) if (i := block.find(sep)) >= 0]
    cut = min(cuts, default=len(block))
    return block[:cut], block[cut:]


ARC_COLUMNS = "archive string, offset long, url string, ip string, date string, mime string, kind string, page_id long, payload_digest string, payload_bytes long, truncated boolean"


def _page_id(head: bytes) -> int | None:
    m = re.search(rb"\r\nX-Page-Id: (-?\d+)\r\n", head)
    return int(m[1]) if m else None


def _arc_rows(with_block: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    types = {"archive": pa.string(), "offset": pa.int64(), "url": pa.string(), "ip": pa.string(), "date": pa.string(), "mime": pa.string(), "kind": pa.string(),
             "page_id": pa.int64(), "payload_digest": pa.string(), "payload_bytes": pa.int64(), "truncated": pa.bool_()} | ({"block": pa.binary()} if with_block else {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                archive, rows = path.rsplit("/", 1)[-1], []
                for r in parse_arc(inflate(content.as_py())):
                    head, payload = _split_http(r["block"])
                    kind = "warcinfo" if r["URL"].startswith("filedesc:") else "response" if head else "resource"
                    rows.append((archive, r["offset"], r["URL"], r["IP-address"], r["Archive-date"], r["Content-type"], kind, _page_id(head),
                                 hashlib.sha256(payload).hexdigest(), len(payload), r["truncated"], *([r["block"]] if with_block else [])))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types.values())], names=list(types))
    return run


def read_arc(spark: SparkSession, path: str, with_block: bool = True) -> DataFrame:
    """One row per ARC record, the version block (kind warcinfo) included."""
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")
    return files.mapInArrow(_arc_rows(with_block), ARC_COLUMNS + (", block binary" if with_block else ""))


# --- WARC --------------------------------------------------------------------------------------

def record_id(archive: str, offset: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'arc:{archive}#{offset}')}>"


def warc_date(date: str) -> str:
    """ARC's digits (14, or fewer in old files) as an ISO timestamp; unreadable ones as the epoch."""
    d = (date + "00000101000000"[len(date):]) if date.isdigit() and 4 <= len(date) <= 14 else "19700101000000"
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def warc_record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def _convert(batch: pa.RecordBatch) -> Iterator[bytes]:
    for r in batch.to_pylist():
        block, kind = r["block"], r["kind"]
        fields = [("WARC-Type", "revisit" if r["to_archive"] is not None else kind), ("WARC-Record-ID", record_id(r["archive"], r["offset"])), ("WARC-Date", warc_date(r["date"]))]
        if kind == "warcinfo":
            fields += [("WARC-Filename", r["url"].removeprefix("filedesc://")), ("Content-Type", "text/plain")]
            yield warc_record(fields, block)
            continue
        fields += [("WARC-Target-URI", r["url"]), ("WARC-IP-Address", r["ip"]), ("WARC-Payload-Digest", f"sha256:{r['payload_digest']}")]
        if r["to_archive"] is not None:
            block = _split_http(block)[0]
            fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(r["to_archive"], r["to_offset"]))]
            fields += [("X-Refers-To-Page-Id", str(r["to_page"]))] if r["to_page"] is not None else []
            fields.append(("WARC-Truncated", "length"))
        elif r["truncated"]:
            fields.append(("WARC-Truncated", "unspecified"))
        fields += [("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"), ("Content-Type", "application/http; msgtype=response" if kind == "response" else r["mime"])]
        yield warc_record(fields, block)


def convert(spark: SparkSession, arc_path: str, warc_path: str, least: int = MIN_REVISIT) -> None:
    """Writes WARC files for all ARC files under ``arc_path``.

    Of equal response payloads of ``least`` bytes or more the one with the smallest page id, then
    place, is the response. Which records are revisits is found on digests alone; payloads are
    joined only with that list, which Spark broadcasts where its file is small."""
    index = read_arc(spark, arc_path, with_block=False).where("kind = 'response'").select("archive", "offset", "page_id", "payload_digest", "payload_bytes")
    index = persisted(index.where(F.col("payload_bytes") >= least), "index")
    # A digest's smallest record; records without a page id come last.
    place = F.struct(F.col("page_id").isNull().alias("none"), F.col("page_id").alias("to_page"), F.col("archive").alias("to_archive"), F.col("offset").alias("to_offset"))
    groups = index.groupBy("payload_digest").agg(F.min(place).alias("to"), F.count(F.lit(1)).alias("n")).where("n > 1").select("payload_digest", "to.to_page", "to.to_archive", "to.to_offset")
    revisits = index.join(groups, "payload_digest").where("archive <> to_archive or offset <> to_offset").select("archive", "offset", "to_page", "to_archive", "to_offset")
    revisits = persisted(revisits, "revisits")
    records = read_arc(spark, arc_path).join(revisits, ["archive", "offset"], "left")
    info = warc_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id("converter", 0)), ("WARC-Date", warc_date(DATE)), ("Content-Type", "application/warc-fields")], b"software: repsmith\r\nformat: WARC File Format 1.1\r\n")
    _write(records.mapInArrow(_segments(lambda _: info, _convert), "segment binary"), warc_path)


def parse_warc(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields in lower case, block) of each record, by its Content-Length."""
    at = 0
    while at < len(raw):
        if raw[at] in b"\r\n\0":
            at += 1
            continue
        end = raw.find(b"\r\n\r\n", at)
        lines = raw[at:end].decode("utf-8", "replace").split("\r\n")
        if end < 0 or not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        length = int(fields["content-length"])
        yield fields, raw[end + 4:end + 4 + length]
        at = end + 4 + length


WARC_COLUMNS = "archive string, record_id string, record_type string, url string, date string, page_id long, payload_bytes long, payload_digest string, refers_to_record string, refers_to long"


def _warc_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in WARC_COLUMNS.split(", ")]
    types = [pa.int64() if c.endswith(" long") else pa.string() for c in WARC_COLUMNS.split(", ")]
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
            rows = []
            for f, block in parse_warc(inflate(content.as_py())):
                kind = f["warc-type"]
                head, payload = _split_http(block)
                size, digest = len(payload), hashlib.sha256(payload).hexdigest()
                if kind == "revisit":  # the payload is the response's: its length and digest are the record's claims
                    m = re.search(rb"\r\nContent-Length: (\d+)\r\n", head)
                    size, digest = int(m[1]) if m else None, f["warc-payload-digest"].removeprefix("sha256:")
                elif kind in ("response", "resource") and f.get("warc-payload-digest") != f"sha256:{digest}":
                    raise ValueError(f"payload of {f['warc-record-id']} differs from its digest")
                to = f.get("x-refers-to-page-id")
                rows.append((path.rsplit("/", 1)[-1], f["warc-record-id"], kind, f.get("warc-target-uri"), f["warc-date"], _page_id(head), size, digest, f.get("warc-refers-to"), int(to) if to else None))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per WARC record, digests checked against the payloads."""
    return spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content").mapInArrow(_warc_rows, WARC_COLUMNS)


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Pages to ARC, ARC to WARC, WARC read back: one row per page. Repeated page ids are told apart by
    their place; an empty table gives no rows."""
    spark = pages.sparkSession
    arc, warc = scratch(spark, "arc"), scratch(spark, "warc")
    write_pages_as_arc(pages, arc, id_col, url_col, html_col)
    convert(spark, arc, warc)
    return read_warc(spark, warc).where("record_type in ('response', 'revisit')")
