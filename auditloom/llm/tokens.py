"""Token ids as Parquet list columns with chosen encodings, row groups and page indexes.

Documents are range-partitioned and sorted by id before they are encoded, so the files
stand in id order and the text crosses the network once. The ids column is dictionary
encoded (a byte-pair vocabulary fits one dictionary page) and the metadata columns are
delta encoded. A page holds ``PAGE_ROWS`` documents at most and has its place and its least
and greatest id in the page index: ``read_documents`` opens only files that can hold what
was asked for, and reads only the pages that can; ``token_index`` reads the metadata alone.

Encoding is that of the tokenizers library: a text is split by the vocabulary's own
pattern and every distinct piece goes to the library's model once per worker; texts with
characters beyond the Latin ranges, control characters or a special token's opening go to
the library whole.

Defined results: a null text is empty and holds only the end id; null ids stand first;
rows of one id are all kept, in the order of a hash of their text and then of the text, so
reruns agree and an id that very many rows share is spread over files; very long texts are
encoded whole; columns beyond the two are left out; an empty table gives an empty dataset.
"""

from __future__ import annotations

import array
import re
import uuid
import zlib
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditloom.llm import store
from auditloom.llm.common import cut, kept_by_worker, running_total, scratch_path, small_batches

#: Pieces a worker remembers before it starts anew; this bounds memory alone.
REMEMBERED = 400_000
#: Documents of a page at most; a selective read fetches whole pages.
PAGE_ROWS = 64
#: Ids asked for in one scan; more are asked for in several.
ASKED = 128

#: Latin text, on which Python's character classes agree with the vocabulary's pattern.
_ODD = re.compile("[^\t-\r -~À-ÖØ-öø-ɏ]")
_PIECE = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ɏ]+| ?[0-9]+|'(?:s|t|re|ve|m|ll|d)| ?(?:_|[^\s\w])+|\s+(?!\S)|\s+")


class _Pieces(dict):
    """Piece of text to its ids, as little-endian unsigned 32-bit integers."""

    def __init__(self, tokenizer) -> None:
        from tokenizers import pre_tokenizers

        self.tokenizer = tokenizer
        alphabet = sorted(pre_tokenizers.ByteLevel.alphabet(), key=ord)
        # Byte-level characters below 256 stand for themselves; the others follow in byte order.
        own = {ord(c) for c in alphabet if ord(c) < 256}
        rest = iter(c for c in alphabet if ord(c) >= 256)
        self.level = {b: (b if b in own else next(rest)) for b in range(256)}

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        shown = piece.encode("utf-8").decode("latin-1").translate(self.level)
        self[piece] = ids = array.array("I", [t.id for t in self.tokenizer.model.tokenize(shown)]).tobytes()
        return ids


class ByteLevelEncoder:
    """Ids of texts under a byte-level vocabulary file of the tokenizers library."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.pieces = _Pieces(self.tokenizer)

    def __call__(self, text: str) -> bytes:
        if "<|" in text or _ODD.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        # In blocks of pieces, so a very long text holds no list of all its pieces.
        if len(text) < 1 << 20:
            return b"".join(map(self.pieces.__getitem__, _PIECE.findall(text)))
        return b"".join(self.pieces[m[0]] for m in _PIECE.finditer(text))


def encoder(path: str) -> ByteLevelEncoder:
    return kept_by_worker(("pieces", path), lambda: ByteLevelEncoder(path))


_FILE = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))])
_MANIFEST = pa.schema([("part", pa.int32()), ("file", pa.string()), ("grp", pa.int32()), ("n_rows", pa.int64()), ("n_tokens", pa.int64()), ("low", pa.int64()), ("high", pa.int64())])


def write_tokens(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", end_id: int | None = 0, path: str | None = None, group_tokens: int = 4 << 20, page_bytes: int = 64 << 10) -> DataFrame:
    """Encode ``docs`` into files of ``(doc_id, n_tokens, ids)`` in ascending id order.

    Returns the manifest: a row per row group with its place, its rows and tokens, its first
    and last id (``low``, ``high``) and ``start``, the tokens before it. A file has the name of its task's attempt, and only
    files in the manifest count. A row group holds about ``group_tokens`` tokens.
    """
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    root = path or scratch_path(spark, "tokens")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    # Ids are told apart by a hash of the text, so rows of one id can be spread, and equal ones lie together.
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order, "text")
    end = b"" if end_id is None else int(end_id).to_bytes(4, "little")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, part = encoder(vocabulary), TaskContext.get().partitionId()
        file, writer, out = f"{root}/part-{part:06d}-{uuid.uuid4().hex}.parquet", None, None
        held_ids, held, tokens, group = [], [], 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal writer, out, tokens, group
            if writer is None:
                out = store.create(file)
                writer = pq.ParquetWriter(
                    out, _FILE, compression="zstd", compression_level=1, use_dictionary=["ids.list.element"], dictionary_pagesize_limit=1 << 20,
                    column_encoding={"doc_id": "DELTA_BINARY_PACKED", "n_tokens": "DELTA_BINARY_PACKED"}, data_page_size=page_bytes, max_rows_per_page=PAGE_ROWS, write_page_index=True,
                )
            n = np.array([len(x) // 4 for x in held], dtype=np.int64)
            ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(np.frombuffer(b"".join(held), dtype="<i4")))
            writer.write_table(pa.Table.from_arrays([pa.array(held_ids, pa.int64()), pa.array(n), ids], schema=_FILE), row_group_size=len(held))
            done = pa.RecordBatch.from_pylist([{"part": part, "file": file, "grp": group, "n_rows": len(held), "n_tokens": tokens, "low": held_ids[0], "high": held_ids[-1]}], schema=_MANIFEST)
            held_ids.clear()
            held.clear()
            tokens, group = 0, group + 1
            return done

        try:
            for whole in batches:
                for at in range(0, whole.num_rows, 256):
                    batch = whole.slice(at, 256)
                    held_ids += batch.column(0).to_pylist()
                    for x in batch.column(1).to_pylist():
                        held.append(ids_of(x) + end)
                        tokens += len(held[-1]) // 4
                    if tokens >= group_tokens:
                        yield flush()
            if held:
                yield flush()
        finally:
            if writer is not None:
                writer.close()
                out.close()

    manifest = cut(rows.mapInArrow(write, "part int, file string, grp int, n_rows long, n_tokens long, low long, high long"), "manifest")
    return running_total(manifest, [F.col("part"), F.col("grp")], F.col("n_tokens"), "start")


def _groups(manifest: DataFrame, read, schema: pa.Schema, ddl: str) -> DataFrame:
    """``read(file, grp, start)`` for every row group of the manifest, a few groups a task."""
    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, source = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["file"] != name:
                    name, source = row["file"], pq.ParquetFile(store.open_at(row["file"]))
                yield from pa.Table.from_arrays(read(source, row["grp"], row["start"]), schema=schema).to_batches()

    chosen = manifest.select("part", "file", "grp", "start").repartitionByRange(parts, "part", "grp").sortWithinPartitions("part", "grp")
    return chosen.mapInArrow(run, ddl)


def read_tokens(manifest: DataFrame) -> DataFrame:
    """The documents of the manifest's row groups: ``doc_id, start, n_tokens, ids``."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def read(source: pq.ParquetFile, group: int, start: int) -> list:
        table = source.read_row_group(group).combine_chunks()
        n = table["n_tokens"].to_numpy()
        return [table["doc_id"], pa.array(start + np.cumsum(n) - n), table["n_tokens"], table["ids"]]

    return _groups(manifest, read, schema, "doc_id long, start long, n_tokens long, ids array<int>")


def read_documents(manifest: DataFrame, doc_ids: Sequence[int]) -> DataFrame:
    """``doc_id, n_tokens, ids`` of the documents with one of ``doc_ids``, by the page index.

    The ids are a list that a caller names, not a table: the plan grows with it. Ids that no
    document has give no row; documents without an id can't be asked for.
    """
    spark, schema = manifest.sparkSession, "doc_id long, n_tokens long, ids array<int>"
    wanted, found = sorted({int(i) for i in doc_ids}), None
    for at in range(0, len(wanted), ASKED):
        some = wanted[at : at + ASKED]
        reach = F.exists(F.array(*map(F.lit, some)), lambda x: (x >= F.coalesce("low", F.lit(-(1 << 63)))) & (x <= F.col("high")))
        files = [r["file"] for r in manifest.where(reach).select("file").distinct().orderBy("file").collect()]
        if files:
            # Equalities reach the reader one by one; a long IN would reach it as a range.
            rows = spark.read.schema(schema).parquet(*files).where(_any([F.col("doc_id") == i for i in some]))
            found = rows if found is None else found.unionByName(rows)
    return spark.createDataFrame([], schema) if found is None else found


def _any(terms: list[Column]) -> Column:
    """A balanced disjunction."""
    while len(terms) > 1:
        terms = [reduce(Column.__or__, terms[k : k + 2]) for k in range(0, len(terms), 2)]
    return terms[0]


def token_index(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens`` alone: the ids' pages are not read."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])

    def read(source: pq.ParquetFile, group: int, start: int) -> list:
        table = source.read_row_group(group, columns=["doc_id", "n_tokens"])
        n = table["n_tokens"].to_numpy()
        return [table["doc_id"], pa.array(start + np.cumsum(n) - n), table["n_tokens"]]

    return _groups(manifest, read, schema, "doc_id long, start long, n_tokens long")


def token_checks(manifest: DataFrame) -> DataFrame:
    """Per stored document ``doc_id, start, n_tokens, ids_crc32``, all from the ids read back."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def read(source: pq.ParquetFile, group: int, start: int) -> list:
        table = source.read_row_group(group, columns=["doc_id", "ids"]).combine_chunks()
        ids = table["ids"].chunk(0)
        view = memoryview(np.ascontiguousarray(ids.flatten().to_numpy().astype("<u4", copy=False)).view(np.uint8))
        n = ids.value_lengths().to_numpy().astype(np.int64)
        ends = np.cumsum(n)
        sums = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip((ends - n).tolist(), ends.tolist(), strict=True)]
        return [table["doc_id"], pa.array(start + ends - n), pa.array(n), pa.array(sums, pa.int64())]

    return _groups(manifest, read, schema, "doc_id long, start long, n_tokens long, ids_crc32 long")
