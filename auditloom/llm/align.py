"""Alignment of two tokenizers over the same bytes, a whole Arrow batch at a time.

A batch's texts are one run of bytes with document offsets. The ends of both tokenizers'
tokens are counted per byte; where both end, the text is cut into groups. Every stretch
between two ends of either kind lies in one token of each, so the stretches are the links,
all overlapping pairs of occurrences. Prefix sums over the bytes give every document's
tokens, groups and links at its own two offsets.

How often an id pair is linked in the whole corpus is counted in two steps. A task gathers
documents to chunks of about ``CHUNK`` links and counts a chunk's pairs, so a pair that every
document has is one row a chunk; a chunk's documents refer to its pairs by number, as
compressed differences. Totals by pair and the highest of every B id go back to the chunks
by equi-joins, one chunk at a time. Only a table with a row per id of B is broadcast.

Texts are split where no token can reach across, and each distinct piece goes to the
tokenizer once a worker: by the vocabulary's pattern for A, for B between characters that
no piece has side by side. A piece is compared with its ids' bytes when it is first met; once one
differs, or where a text goes to a tokenizer whole, whole texts are.

Defined results: a text that is null, empty or not given back by either tokenizer has no
tokens, and all its counts are 0 and its digest empty; strings of special tokens are plain
text; very long texts are aligned whole, as a batch of their own; repeated rows count each
time; rows of one id stay apart; ids are passed through, null ones and strings too; columns
beyond the two are left out, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import array
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from auditloom.llm.common import cut, forget, kept_by_worker, small_batches
from auditloom.llm.tokens import _ODD, ByteLevelEncoder, _Pieces

#: Links of a chunk, about: what a task holds of one, and the documents that share its pair counts.
CHUNK = 4 << 20
#: Bytes of text that are aligned at once; a longer text stands alone.
BLOCK = 4 << 20
#: Pieces of text that a worker remembers per tokenizer; this bounds memory alone.
REMEMBERED = 400_000
#: An id pair is one number: A's id in the high bits.
BITS = 20

_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"


class _Checked(_Pieces):
    """Pieces of A, each compared with the bytes of its ids when it is first met."""

    def __init__(self, tokenizer) -> None:
        super().__init__(tokenizer)
        self.wrong = False

    def __missing__(self, piece: str) -> bytes:
        ids = super().__missing__(piece)
        own = self.bytes
        self.wrong |= b"".join([own[i] for i in memoryview(ids).cast("I")]) != piece.encode("utf-8")
        return ids


class _BytePair(ByteLevelEncoder):
    """A: a byte-level vocabulary file; every string is plain text."""

    def __init__(self, path: str) -> None:
        super().__init__(path)
        self.tokenizer.encode_special_tokens = True
        self.pieces = _Checked(self.tokenizer)
        alphabet = {chr(c) if isinstance(c, int) else c: b for b, c in self.pieces.level.items()}
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        shown = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.bytes = self.pieces.bytes = [bytes(map(alphabet.__getitem__, t)) if all(c in alphabet for c in t) else t.encode() for t in shown]

    def whole(self, text: str) -> bool:
        """Whether the text's ids may differ from its bytes: it goes to the library whole, or a piece has once been wrong."""
        return self.pieces.wrong or "<|" in text or _ODD.search(text) is not None


class _SentencePieces:
    """B: a model of the sentencepiece library, which puts a blank before a text.

    A merge makes a piece, so none reaches across two characters that stand side by side in no
    piece: texts are cut between such ones, before blanks, between letters and what follows
    them, and around characters that no longer piece has.
    """

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.bytes = [bytes([int(p[3:-1], 16)]) if model.is_byte(i) else p.replace("\u2581", " ").encode() for i, p in enumerate(pieces)]
        long_ = [p for i, p in enumerate(pieces) if len(p) > 1 and not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        letter = re.compile(f"[{_LETTER}]")
        others = [chr(c) for c in (9, 10, 13, *range(33, 127)) if not letter.match(chr(c))]
        inside = {c for p in long_ for c in p}
        after = {b for p in long_ for a, b in zip(p, p[1:], strict=False) if letter.match(a)}
        lone = re.escape("".join(c for c in others if c not in inside))
        end = re.escape("".join(c for c in others if c not in after)) + lone
        self.unit = re.compile(rf" *[{_LETTER}]+(?=[ {end}]|\Z)|[{lone}]| *[^ {lone}]+| +")
        self.first = model.encode("\n")
        # Units without a blank before them are encoded after a line end, which stands alone.
        self.apart = "\n" not in inside and len(self.first) == 2 and not any("\u2581" in p.lstrip("\u2581") for p in long_)
        self.known: dict[str, bytes] = {}
        self.wrong = False

    def __call__(self, text: str) -> bytes:
        """Ids of blank + text; ``text`` has the blank already."""
        if not self.apart:
            return np.array(self.model.encode(text[1:]), dtype="<u4").tobytes()
        units = self.unit.findall(text)
        new = [u for u in dict.fromkeys(units) if u not in self.known]
        if new:
            if len(self.known) + len(new) > REMEMBERED:
                self.known.clear()
                new = list(dict.fromkeys(units))
            worded = [u[0] == " " and u[-1] != " " for u in new]
            for u, own, ids in zip(new, worded, self.model.encode([u[1:] if w else "\n" + u for u, w in zip(new, worded, strict=True)], num_threads=1), strict=True):
                own = ids if own else ids[2:]
                self.wrong |= b"".join(map(self.bytes.__getitem__, own)) != u.encode("utf-8", "surrogatepass")
                self.known[u] = array.array("I", own).tobytes()
        return b"".join(map(self.known.__getitem__, units))

    def whole(self, text: str) -> bool:
        """Whether the text's ids may differ from its bytes."""
        return self.wrong or not self.apart


class Aligner:
    """Both tokenizers with the tables of their tokens' lengths and decimal names."""

    def __init__(self, a: str, b: str) -> None:
        self.a, self.b = _BytePair(a), _SentencePieces(b)
        self.length_a, self.length_b = (np.array([len(x) for x in t.bytes], dtype=np.int64) for t in (self.a, self.b))
        # An id's name with what follows it: first within its side of a group, then at the side's end; B's names after A's.
        names = [f"{i}{sep}".encode() for n, ends in ((len(self.length_a), ",|"), (len(self.length_b), ",;")) for i in range(n) for sep in ends]
        self.names = np.array(names, dtype=bytes)  # padded with zero bytes, which no name has

    def tokens(self, text: str | None) -> tuple[bytes, np.ndarray, np.ndarray]:
        """The bytes of blank + text and both tokenizers' ids; nothing where one doesn't give the bytes back."""
        none = np.zeros(0, dtype=np.uint32)
        if not text:
            return b"", none, none
        spaced = " " + text
        raw = spaced.encode("utf-8", "surrogatepass")
        a, b = (np.frombuffer(t(spaced), dtype="<u4") for t in (self.a, self.b))
        for ids, lengths, own in ((a, self.length_a, self.a), (b, self.length_b, self.b)):
            if int(lengths[ids].sum()) != len(raw) or (own.whole(spaced) and b"".join(map(own.bytes.__getitem__, ids.tolist())) != raw):
                return b"", none, none
        return raw, a, b

    def align(self, texts: list[str | None]) -> tuple[dict[str, np.ndarray], list[str], np.ndarray, np.ndarray]:
        """A block's counts per document, its digests, its links as pair numbers, and every document's first link."""
        found = [self.tokens(x) for x in texts]
        bounds = np.concatenate([[0], np.cumsum([len(raw) for raw, _, _ in found])]).astype(np.int64)
        total = int(bounds[-1])
        a, b = np.concatenate([f[1] for f in found]), np.concatenate([f[2] for f in found])
        # Ends per byte: place k stands for an end after k bytes.
        ends_a = np.bincount(np.cumsum(self.length_a[a]), minlength=total + 1).astype(bool)
        ends_b = np.bincount(np.cumsum(self.length_b[b]), minlength=total + 1).astype(bool)
        both, either = ends_a & ends_b, ends_a | ends_b
        narrow = np.int32 if total < 1 << 31 else np.int64
        upto_a, upto_b, upto_both, upto_either = (np.cumsum(x, dtype=narrow) for x in (ends_a, ends_b, both, either))
        counts = {k: np.diff(x[bounds]) for k, x in (("n_a", upto_a), ("n_b", upto_b), ("n_groups", upto_both), ("n_links", upto_either))}
        stretch = np.flatnonzero(either)
        # The token a stretch lies in is the one after those that ended before the stretch's end.
        pairs = a[(upto_a - ends_a)[stretch]].astype(np.int64) << BITS | b[(upto_b - ends_b)[stretch]].astype(np.int64)
        # Names in the order A tokens, B tokens by group: a token's place is its number and that of the other side's before it.
        shared = np.flatnonzero(both)
        last_a, last_b = np.zeros(len(a), dtype=np.int64), np.zeros(len(b), dtype=np.int64)
        last_a[upto_a[shared] - 1], last_b[upto_b[shared] - 1] = 1, 1
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        before_b = np.concatenate([[0], upto_b[shared]])
        order = np.empty(len(a) + len(b), dtype=np.int64)
        order[np.arange(len(a)) + before_b[group_a]] = 2 * a.astype(np.int64) + last_a
        order[np.arange(len(b)) + upto_a[shared][group_b]] = 2 * len(self.length_a) + 2 * b.astype(np.int64) + last_b
        at, digests = 0, []
        for n in (counts["n_a"] + counts["n_b"]).tolist():
            named = self.names[order[at : at + n]].tobytes().translate(None, b"\0")
            digests.append(hashlib.sha256(named[:-1]).hexdigest() if n else "")
            at += n
        return counts, digests, pairs, np.concatenate([[0], np.cumsum(counts["n_links"])])


def pack(numbers: np.ndarray) -> bytes:
    """Ascending numbers as compressed differences, byte planes apart."""
    import zstandard

    steps = np.diff(numbers, prepend=0).astype("<u4")
    return zstandard.ZstdCompressor(level=1).compress(steps.view(np.uint8).reshape(-1, 4).T.tobytes())


def unpack(raw: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype=np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64))


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def _chunks(docs: DataFrame, a: str, b: str) -> DataFrame:
    """A row per chunk: its documents' ids, counts and digests, its pairs with their counts, and which pairs each document has how often.

    ``links`` holds, packed, the numbers ``document * pairs + pair``, ``times`` how often each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = kept_by_worker(("align", a, b), lambda: Aligner(a, b))
        part, made = TaskContext.get().partitionId(), 0
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            nonlocal made
            ids = pa.concat_arrays([h[0] for h in held])
            counts = [np.concatenate([h[1][k] for h in held]) for k in _COUNTS]
            digests = [d for h in held for d in h[2]]
            pairs, place, n = np.unique(np.concatenate([h[3] for h in held]), return_inverse=True, return_counts=True)
            own = np.repeat(np.arange(len(ids), dtype=np.int64), counts[3]) * max(1, len(pairs)) + place
            own.sort()
            first = np.flatnonzero(np.diff(own, prepend=-1))
            times = np.diff(first, append=len(own))
            one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
            row = [pa.array([part << 32 | made], pa.int64()), one(ids), *[one(pa.array(c.astype(np.int64))) for c in counts], one(pa.array(digests, pa.string()))]
            row += [pa.array([pack(own[first])], pa.binary()), pa.array([pack(np.cumsum(times))], pa.binary()), one(pa.array(pairs)), one(pa.array(n.astype(np.int64)))]
            made += 1
            held.clear()
            return pa.RecordBatch.from_arrays(row, names=names)

        links = 0
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy()
            block = (np.cumsum(sizes) - sizes) // BLOCK
            starts = [*np.flatnonzero(np.diff(block, prepend=-1)).tolist(), batch.num_rows]
            for at, end in zip(starts, starts[1:], strict=False):
                counts, digests, pairs, _ = aligner.align(batch.column(1).slice(at, end - at).to_pylist())
                ids = batch.column(0).slice(at, end - at)
                held.append((ids, counts, digests, pairs))
                links += len(pairs)
                if links >= CHUNK:
                    yield flush()
                    links = 0
        if held:
            yield flush()

    rest = ", ".join(f"{k} array<long>" for k in _COUNTS) + ", groups_sha256 array<string>, links binary, times binary, pairs array<long>, counts array<long>"
    schema = StructType([StructField("chunk", LongType()), StructField("doc_ids", ArrayType(docs.schema["doc_id"].dataType)), *StructType.fromDDL(rest).fields])
    names = schema.names
    return docs.mapInArrow(run, schema)


def align_documents(docs: DataFrame, a: str, b: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` under vocabulary files ``a`` (byte-level) and ``b`` (sentencepiece).

    ``n_best`` counts the links whose id pair is linked as often in the corpus as any pair of
    its B id, ``count_sum`` adds up how often the links' pairs are linked.
    """
    small_batches(docs.sparkSession)
    chunks = cut(_chunks(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), a, b), "chunks")
    own = chunks.select("chunk", F.posexplode(F.arrays_zip("pairs", "counts")).alias("pos", "x")).select("chunk", "pos", F.col("x.pairs").alias("pair"), F.col("x.counts").alias("n"))
    totals = cut(own.groupBy("pair").agg(F.sum("n").alias("total")), "totals")
    b_id = F.col("pair").bitwiseAND(F.lit((1 << BITS) - 1))
    # A row per id of B at most: the vocabulary file bounds it.
    highest = totals.groupBy(b_id.alias("b")).agg(F.max("total").alias("most"))
    rated = totals.withColumn("b", b_id).join(F.broadcast(highest), "b").select("pair", "total", (F.col("total") == F.col("most")).alias("best"))
    back = own.join(rated, "pair").select(F.col("chunk").alias("of"), "pos", "total", "best")
    kind = docs.schema[doc_id].dataType
    schema = StructType([StructField("doc_id", kind), *StructType.fromDDL("n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string").fields])

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        """A chunk's documents with what their links count."""
        size = right.num_rows
        total, best = np.zeros(max(1, size), dtype=np.int64), np.zeros(max(1, size), dtype=np.int64)
        at = right["pos"].to_numpy()
        total[at], best[at] = right["total"].to_numpy(), right["best"].to_numpy(zero_copy_only=False)
        column = lambda k: pc.list_flatten(left[k]).combine_chunks()
        ids = column("doc_ids")
        links, times = unpack(left["links"][0].as_py()), np.diff(unpack(left["times"][0].as_py()), prepend=0)
        doc, pair = np.divmod(links, max(1, size))
        # Sums of whole numbers per document, by prefix sums at the documents' first links.
        bounds = np.searchsorted(doc, np.arange(len(ids) + 1))
        sums = [np.diff(np.concatenate([[0], np.cumsum(x[pair] * times)])[bounds]) for x in (best, total)]
        return pa.table([ids, *[column(k) for k in _COUNTS], *[pa.array(s.astype(np.int64)) for s in sums], column("groups_sha256")], names=schema.names)

    whole = chunks.select("chunk", "doc_ids", *_COUNTS, "groups_sha256", "links", "times")
    return whole.groupBy("chunk").cogroup(back.groupBy("of")).applyInArrow(finish, schema)
