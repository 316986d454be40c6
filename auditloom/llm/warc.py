"""WARC archives, index first.

Writing keeps, for every record, its file, offset, length, URL and digest in an index
table; reading starts from any selection of that index, sorts it by file and offset, and
fetches neighbouring records in one byte-range read. Each record is a gzip member of its
own, so a range can be read without what stands before it.

An archive file belongs to one attempt of one task and has a name of its own; only names
in the committed index count, so repeated or lost attempts leave nothing that is read.

Defined results: a null payload is empty; a null URL leaves the header out; control
characters and blanks in a URL are percent-encoded; of pages with equal payloads those
with the smallest id are responses (repeated rows of that id all are); a page without an
id is always a response and is never referred to; a very long payload is one record;
columns beyond the three are left out; an empty table gives no archive.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditloom.llm import store
from auditloom.llm.common import cut, scratch_path

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "page_id long, url string, payload_digest string, record_type string, refers_to long, file string, offset long, length long"
RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def _bare(digest: bytes) -> str:
    return base64.b32encode(digest).decode("ascii")


def _record_id(page_id: int | None, place: str = "") -> str:
    return f"<urn:page:{page_id}>" if page_id is not None else f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, place)}>"


def make_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, place: str = "") -> tuple[bytes, str]:
    """One record as it stands before compression, and its payload digest.

    ``place`` names a record without a page id: the same at every attempt of its task.
    """
    digest = _bare(hashlib.sha1(payload).digest())
    revisit = refers_to is not None
    # The stored HTTP header keeps the payload's length, in a revisit as well.
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode("ascii")
    if not revisit:
        block += payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(page_id, place)}", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    if revisit:
        head += [f"WARC-Refers-To: {_record_id(refers_to)}", f"WARC-Profile: {PROFILE}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n", digest


def parse_record(raw: bytes) -> dict:
    """A record's fields, the payload's digest computed anew where the payload is there."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8").split("\r\n")
    if not first.startswith("WARC/1."):
        raise ValueError("no WARC record at this offset")
    fields = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = int(re.search(rb"(?im)^content-length:\s*(\d+)", http)[1])
    revisit = fields["warc-type"] == "revisit"
    number = lambda v: int(m[1]) if v and (m := re.fullmatch(r"<urn:page:(-?\d+)>", v)) else None
    digest = fields["warc-payload-digest"].removeprefix("sha1:") if revisit else _bare(hashlib.sha1(payload).digest())
    return {
        "page_id": number(fields["warc-record-id"]),
        "url": fields.get("warc-target-uri"),
        "record_type": fields["warc-type"],
        "refers_to": number(fields.get("warc-refers-to")),
        "payload_bytes": stated if revisit else len(payload),
        "payload_digest": digest,
        "payload": None if revisit else payload,
    }


def write_archives(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html", dedup_min_bytes: int = 0, archive_bytes: int = 256 << 20, level: int = 1, path: str | None = None) -> DataFrame:
    """Write ``pages`` as WARC files under ``path`` and return the committed index."""
    root = path or scratch_path(pages.sparkSession, "warc")
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    full = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), body.alias("payload"))
    # Digests travel without their payloads; only those met twice matter.
    narrow = cut(full.select("page_id", F.sha1("payload").alias("sha"), F.octet_length("payload").alias("n")), "digests")
    first = narrow.where(F.col("n") >= dedup_min_bytes).groupBy("sha").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("times"))
    first = cut(first.where("times > 1").drop("times"), "first")
    # Both sides are written tables, so a hot digest's rows can be split among tasks.
    again = narrow.join(first, "sha").where(F.col("page_id") > F.col("refers_to")).select("page_id", "sha", "refers_to").distinct()
    rows = full.withColumn("sha", F.sha1("payload")).join(cut(again, "again"), ["page_id", "sha"], "left")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, file, at, part, n = None, None, 0, TaskContext.get().partitionId(), 0
        try:
            for batch in batches:
                index = []
                for row in batch.to_pylist():
                    n += 1
                    if out is None:
                        file, at = f"{root}/{uuid.uuid4().hex}.warc.gz", 0
                        out = store.create(file)
                    raw, digest = make_record(row["page_id"], row["url"], row["payload"], row["refers_to"], f"{part}/{n}/{row['url']}")
                    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                    member = packer.compress(raw) + packer.flush()
                    out.write(member)
                    index.append({"page_id": row["page_id"], "url": row["url"], "payload_digest": digest, "record_type": "response" if row["refers_to"] is None else "revisit", "refers_to": row["refers_to"], "file": file, "offset": at, "length": len(member)})
                    at += len(member)
                    if at >= archive_bytes:
                        out.close()
                        out = None
                yield pa.RecordBatch.from_pylist(index, schema=_INDEX)
        finally:
            if out is not None:
                out.close()

    return cut(rows.select("page_id", "url", "payload", "refers_to").mapInArrow(write, INDEX), "warc-index")


_INDEX = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
_RECORD = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])


def read_records(index: DataFrame, gap: int = 64 << 10, span: int = 8 << 20, with_payload: bool = True) -> DataFrame:
    """The records that ``index`` selects, read in sorted and coalesced byte ranges.

    Records whose gap is at most ``gap`` bytes share a read of about ``span`` bytes.
    """
    spark = index.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chosen = index.select("file", "offset", "length").repartitionByRange(parts, "file", "offset").sortWithinPartitions("file", "offset")

    def fetch(run: list[tuple[int, int]], source) -> Iterator[dict]:
        source.seek(run[0][0])
        data = memoryview(source.read(run[-1][0] + run[-1][1] - run[0][0]))
        for at, length in run:
            start = at - run[0][0]
            found = parse_record(zlib.decompress(data[start : start + length], 31))
            if not with_payload:
                found["payload"] = None
            yield found

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, source, run = None, None, []
        for batch in batches:
            rows = []
            for file, at, length in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                end = run[-1][0] + run[-1][1] if run else 0
                if run and (file != name or at - end > gap or end - run[0][0] >= span):
                    rows += fetch(run, source)
                    run = []
                    if with_payload:
                        yield pa.RecordBatch.from_pylist(rows, schema=_RECORD)
                        rows = []
                if file != name:
                    if source is not None:
                        source.close()
                    name, source = file, store.open_at(file)
                run.append((at, length))
            yield pa.RecordBatch.from_pylist(rows, schema=_RECORD)
        if run:
            yield pa.RecordBatch.from_pylist(list(fetch(run, source)), schema=_RECORD)
            source.close()

    return chosen.mapInArrow(read, RECORD)
