"""Document fingerprints by content-defined chunking.

A gear hash over the last 32 bytes marks possible ends of chunks; normalised chunking asks
for more zero bits before the usual size and fewer after it, so sizes gather round it. A
fingerprint is the set of chunk digests with their lengths; as boundaries depend on nearby
bytes alone, an insertion changes the chunks it touches and no others. The likeness of a
document to another is the share of its chunks' length that the other has too.

Defined results: a null text is empty, and an empty text has the empty fingerprint; two
empty texts are alike (1.0), an empty and another one are not (0.0); null ids stand first
in order; rows of one id follow one another by a hash of their text, then by the text; the
last document's next is the first, and a single document is its own next; very long texts
are chunked whole; columns beyond the two are left out; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditloom.llm.common import small_batches

LEAST, USUAL, MOST = 16, 64, 512
#: Zero bits asked for before and after the usual size.
STRICT_BITS, LOOSE_BITS = 7, 5
#: The gear table follows from a rule: the first four bytes of each byte's BLAKE2 digest.
GEAR = np.array([int.from_bytes(hashlib.blake2b(bytes([b]), digest_size=4).digest(), "big") for b in range(256)], dtype=np.uint32)
BLOCK = 1 << 18


def _ends(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Possible ends of chunks (offsets after a byte) and whether each is a strict one."""
    strict, loose = np.uint32(((1 << STRICT_BITS) - 1) << (32 - STRICT_BITS)), np.uint32(((1 << LOOSE_BITS) - 1) << (32 - LOOSE_BITS))
    raw, at, hard = np.frombuffer(data, dtype=np.uint8), [], []
    for start in range(0, len(raw), BLOCK):
        lead = min(start, 31)
        h = GEAR[raw[start - lead : start + BLOCK]]
        # Windows of 2, 4, ... 32 bytes, each from two of half its size.
        for width in (1, 2, 4, 8, 16):
            wide = h.copy()
            wide[width:] += h[:-width] << np.uint32(width)
            h = wide
        h = h[lead:]
        found = np.nonzero((h & loose) == 0)[0]
        at.append(found + (start + 1))
        hard.append((h[found] & strict) == 0)
    return (np.concatenate(at), np.concatenate(hard)) if at else (np.empty(0, int), np.empty(0, bool))


def chunk_lengths(data: bytes) -> list[int]:
    """The ends of the chunks of ``data``."""
    out, start = [], 0
    at, hard = _ends(data)
    for end, strict in zip(at.tolist(), hard.tolist(), strict=True):
        while end - start > MOST:
            start += MOST
            out.append(start)
        size = end - start
        if size >= USUAL or strict and size >= LEAST:
            start = end
            out.append(end)
    while len(data) - start > MOST:
        start += MOST
        out.append(start)
    if start < len(data):
        out.append(len(data))
    return out


def chunk_set(text: str) -> dict[int, int]:
    """Chunk digests (48 bits) of a text and their lengths in bytes."""
    from xxhash import xxh64_intdigest

    data, start, out = text.encode("utf-8"), 0, {}
    for end in chunk_lengths(data):
        out[xxh64_intdigest(data[start:end]) >> 16] = end - start
        start = end
    return out


def written(chunks: dict[int, int]) -> str:
    return ",".join(f"{d:012x}:{chunks[d]}" for d in sorted(chunks))


def likeness(a: dict[int, int], b: dict[int, int]) -> float:
    """The share of a's length that b has too."""
    if not a or not b:
        return float(not a and not b)
    return sum(a[d] for d in a.keys() & b.keys()) / sum(a.values())


def with_neighbour(docs: DataFrame, doc_id: str, text: str) -> DataFrame | None:
    """Rows ``block, role, doc_id, text`` dealt so that each document's next one is in its task.

    Blocks are ranges of ids, and within an id of text hashes. A block also gets the first
    document of the next one (role 1), the last one the first document of all (role 2). One
    boundary per block, a number fixed by the shuffle setting, is all that the driver sees;
    rows find their block among the boundaries by bisection, so the plan's size doesn't
    depend on their number. None for an empty table.
    """
    spark = docs.sparkSession
    parts = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("h")]
    ranged = rows.select("doc_id", "h").repartitionByRange(parts, *order)
    first = F.min(F.struct(F.col("doc_id").isNotNull().alias("late"), F.coalesce("doc_id", F.lit(0)).alias("i"), "h"))
    bounds = sorted(tuple(r["first"]) for r in ranged.groupBy(F.spark_partition_id().alias("p")).agg(first.alias("first")).collect())
    if not bounds:
        return None
    sent = spark.sparkContext.broadcast(bounds)

    @F.pandas_udf("array<struct<block:int,role:int>>")
    def places(ids: pd.Series, hashes: pd.Series) -> pd.Series:
        starts, out = sent.value, []
        for i, h in zip(ids.array, hashes.array, strict=True):
            at = (False, 0, h) if pd.isna(i) else (True, int(i), h)
            block = max(0, bisect_right(starts, at) - 1)
            to = [{"block": block, "role": 0}]
            if at == starts[block]:  # the block before it, or the last one, ends with this document
                to.append({"block": block - 1, "role": 1} if block else {"block": len(starts) - 1, "role": 2})
            out.append(to)
        return pd.Series(out, dtype=object)

    ids = F.col("doc_id").cast("string")  # a long column with nulls would reach pandas as doubles
    dealt = rows.withColumn("to", F.explode(places(ids, F.col("h")))).select("to.block", "to.role", "doc_id", "h", "text")
    return dealt.repartitionById(len(bounds), "block").sortWithinPartitions("block", "role", *order, "text").drop("h")


OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprint_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likenesses."""
    small_batches(docs.sparkSession)
    dealt = with_neighbour(docs, doc_id, text)
    if dealt is None:
        return docs.sparkSession.createDataFrame([], OUT)
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def compare(one: tuple, two: tuple) -> list:
        (_, _, i, a, own), (_, _, _, b, other) = one, two
        half = len(a) // 2
        edited = a[: len(a) - half] + b[:half]
        changed = chunk_set(edited)
        return [i, len(a), hashlib.sha256(edited.encode("utf-8")).hexdigest(), written(own), written(changed), likeness(own, changed), likeness(own, other)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            out = []
            for block, role, i, a in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held is None and role:
                    continue  # further rows of the id that stands ahead
                row = (block, role, i, a, chunk_set(a))
                if held is not None:
                    out.append(compare(held, row))
                held = None if role else row
                if len(out) >= 1000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return dealt.mapInArrow(run, OUT)
