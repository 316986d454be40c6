"""Byte-pair encoding through a minimal acyclic transducer of frequent words.

Words are counted over all documents; the most frequent ones (``LEXICON`` at most, which
bounds the driver's memory) are compiled with their ids into a minimal acyclic automaton
whose arcs carry numbers that add up to a word's place in the table of ids. Workers map it
into memory. Words that it lacks are merged exactly, lowest rank and leftmost first.

Defined results: a null text is empty; an empty text has no ids and decodes to the empty
text; a special token's string is that token; an unpaired or unknown sequence can't occur,
as every byte has a token; a text of any length is encoded whole; rows are independent, so
repeated rows repeat their result; words of equal count enter the lexicon in their order,
which changes no ids; columns beyond the two are left out, whatever their names; an empty
table gives an empty result.
"""

from __future__ import annotations

import array
import hashlib
import heapq
import json
import mmap
import re
import tempfile
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditloom.llm.common import kept_by_worker, small_batches

LEXICON = 50_000
#: Longer words are merged, not compiled.
LONGEST = 64
#: Words a worker remembers; half of them go at a time. This bounds memory alone.
REMEMBERED = 600_000
#: Distinct words that a task counts before it hands the counts on.
COUNTED = 250_000
NONE = 1 << 62

_ODD = re.compile("[^\t-\r -~À-ÖØ-öø-ɏ]")
#: The same for ASCII, where bytes can be tried faster.
_PLAIN = bytes([*range(9, 14), *range(32, 127)])
# Letters come first and by range: the alternatives exclude one another but for the apostrophe's.
_LATIN = re.compile(r"[a-zß-öø-ʯⱥⱦ]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|(?:_|[^\s\w])+")


class Lexicon:
    """A compiled lexicon, mapped into memory: ``get(word)`` gives its ids' bytes or None."""

    def __init__(self, compiled: bytes) -> None:
        with tempfile.TemporaryFile() as f:  # without a name: nothing is left behind
            f.write(compiled)
            f.flush()
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        view = memoryview(self.map)
        states, arcs, words, ids = view[:16].cast("I")
        at = 16

        def take(n: int, kind: str):
            nonlocal at
            size = n * (4 if kind == "I" else 1)
            part = view[at : at + size].cast(kind)
            at += (size + 3) // 4 * 4
            return part

        self.first, self.final = take(states + 1, "I"), take(states, "B")
        self.target, self.number, self.offset, self.ids = take(arcs, "I"), take(arcs, "I"), take(words + 1, "I"), take(ids, "I")
        self.labels = at

    def get(self, word: bytes) -> bytes | None:
        state, place, find, base, first = 0, 0, self.map.find, self.labels, self.first
        for k in range(len(word)):
            arc = find(word[k : k + 1], base + first[state], base + first[state + 1]) - base
            if arc < 0:
                return None
            place += self.number[arc]
            state = self.target[arc]
        if not self.final[state]:
            return None
        return self.ids[self.offset[place] : self.offset[place + 1]].tobytes()


def compile_lexicon(words: dict[bytes, bytes]) -> bytes:
    """The minimal acyclic transducer of ``words`` (word to its ids' bytes), as one block of bytes.

    Words are added in order; states that no longer change are replaced by equal ones.
    """
    register: dict[tuple, int] = {}
    made: list[tuple[bool, list[tuple[int, int]]]] = []  # final, arcs
    counts: list[int] = []  # words accepted from a state
    path: list[list] = [[False, []]]  # open states: final, arcs; the last arc leads to the next open one
    before = b""

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            final, arcs = path.pop()
            key = (final, tuple(arcs))
            if key not in register:
                register[key] = len(made)
                made.append((final, arcs))
                counts.append(final + sum(counts[t] for _, t in arcs))
            path[-1][1][-1] = (path[-1][1][-1][0], register[key])

    ordered = sorted(words)
    for word in ordered:
        same = 0
        while same < min(len(word), len(before)) and word[same] == before[same]:
            same += 1
        close(same)
        for b in word[same:]:
            path[-1][1].append((b, -1))
            path.append([False, []])
        path[-1][0] = True
        before = word
    close(0)
    final, arcs = path[0]
    states = [(final, arcs), *made]  # the start is state 0; made states follow
    first, finals, labels, target, number = [0], [], bytearray(), [], []
    for final, arcs in states:
        place = int(final)
        for b, t in arcs:
            labels.append(b)
            target.append(t + 1)
            number.append(place)
            place += counts[t]
        finals.append(final)
        first.append(len(target))
    ids = b"".join(words[w] for w in ordered)
    offset = np.concatenate([[0], np.cumsum([len(words[w]) // 4 for w in ordered])]).astype("<u4")
    pad = lambda x: x + b"\0" * (-len(x) % 4)
    u4 = lambda x: np.array(x, dtype="<u4").tobytes()
    head = u4([len(states), len(target), len(ordered), len(ids) // 4])
    return head + u4(first) + pad(bytes(finals)) + u4(target) + u4(number) + offset.tobytes() + ids + bytes(labels)


class WordVocabulary:
    """A vocabulary file of word-end BPE: splitting, exact merging, decoding."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        model = said["model"]
        vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in said["added_tokens"]}
        known = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.tokens = np.array([known.get(i, "") for i in range(max(known) + 1)], dtype=object)
        self.suffix = model["end_of_word_suffix"]
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        pieces = next(p for p in said["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = pieces["pattern"]["Regex"]
        # The byte-level alphabet: printable Latin-1 stands for itself, other bytes follow in order.
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = iter(range(256, 512))
        level = [chr(b) if b in shown else chr(next(others)) for b in range(256)]
        self.inner = [vocab[c] for c in level]
        self.last = [vocab[c + self.suffix] for c in level]
        self.merges = {vocab[a] << 16 | vocab[b]: rank << 16 | vocab[a + b] for rank, (a, b) in enumerate(map(tuple, model["merges"]))}
        # What two bytes that stand before a word's last merge to.
        self.firsts = [[self.merges.get(a << 16 | b, NONE) for b in self.inner] for a in self.inner]
        self.unicode = None

    def words(self, text: str) -> Iterable[str]:
        """The words of a text without special tokens."""
        if not (text.encode("ascii").translate(None, _PLAIN) if text.isascii() else _ODD.search(text)):
            return _LATIN.findall(text.lower())
        if self.unicode is None:
            import regex

            self.unicode = regex.compile(self.pattern)
        # Case is folded character by character, without regard to a word's end.
        return self.unicode.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def parts(self, text: str) -> Iterator[tuple[bool, str]]:
        """Special tokens and the texts between them."""
        if "<|" not in text:
            yield False, text
            return
        for k, part in enumerate(self.split_special.split(text)):
            if part:
                yield bool(k % 2), part

    def merge(self, word: bytes) -> bytes:
        """The ids of one word, lowest rank and leftmost pair first."""
        ids = list(map(self.inner.__getitem__, word))
        ids[-1] = self.last[word[-1]]
        if len(ids) > LONGEST:
            return self._merge_long(ids)
        get, firsts = self.merges.get, self.firsts
        pairs = [firsts[a][b] for a, b in pairwise(word)]
        if pairs:
            pairs[-1] = get(ids[-2] << 16 | ids[-1], NONE)
        while pairs:
            best = min(pairs)
            if best == NONE:
                break
            i = pairs.index(best)
            ids[i] = new = best & 0xFFFF
            del ids[i + 1], pairs[i]
            if i < len(pairs):
                pairs[i] = get(new << 16 | ids[i + 1], NONE)
            if i:
                pairs[i - 1] = get(ids[i - 1] << 16 | new, NONE)
        return array.array("I", ids).tobytes()

    def _merge_long(self, ids: list[int]) -> bytes:
        get, n = self.merges.get, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m, i, ids[i], ids[i + 1]) for i in range(n - 1) if (m := get(ids[i] << 16 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            m, i, a, b = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else n
            if j >= n or ids[i] != a or ids[j] != b:
                continue
            ids[i], ids[j] = m & 0xFFFF, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if (m := get(ids[i] << 16 | ids[after[i]])) is not None:
                    heapq.heappush(heap, (m, i, ids[i], ids[after[i]]))
            if (k := before[i]) >= 0 and (m := get(ids[k] << 16 | ids[i])) is not None:
                heapq.heappush(heap, (m, k, ids[k], ids[i]))
        return array.array("I", [x for x in ids if x >= 0]).tobytes()

    def decode(self, ids: np.ndarray) -> str:
        """Tokens joined by blanks, special ones included, as a file without a decoder asks."""
        return " ".join(self.tokens[ids].tolist())


class Encoder(dict):
    """Texts to ids; a mapping of the words met of late, those met before apart."""

    def __init__(self, vocabulary: WordVocabulary, lexicon: Lexicon | None = None) -> None:
        self.vocabulary, self.lexicon, self.before = vocabulary, lexicon, {}

    def __missing__(self, word: str) -> bytes:
        if len(self) >= REMEMBERED // 2:
            self.before = dict(self)
            self.clear()
        ids = self.before.get(word)
        if ids is None:
            raw = word.encode("utf-8")
            ids = self.lexicon.get(raw) if self.lexicon else None
            ids = self.vocabulary.merge(raw) if ids is None else ids
        self[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        out = []
        for special, part in self.vocabulary.parts(text):
            out += [self.vocabulary.special[part].to_bytes(4, "little")] if special else map(self.__getitem__, self.vocabulary.words(part))
        return b"".join(out)


_vocabularies: dict[str, WordVocabulary] = {}


def vocabulary(path: str) -> WordVocabulary:
    if path not in _vocabularies:
        _vocabularies[path] = WordVocabulary(path)
    return _vocabularies[path]


def count_words(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``word, n`` over all documents, counted per task before the words are shuffled."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, counts = kept_by_worker(("words", path), lambda: vocabulary(path)), Counter()

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], schema=schema)
            counts.clear()
            return batch

        for batch in batches:
            for x in batch.column(0).to_pylist():
                for special, part in own.parts(x):
                    if not special:
                        counts.update(own.words(part))
                if len(counts) > COUNTED:
                    yield flush()
        yield flush()

    parts = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text")).mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(docs: DataFrame, path: str, text: str = "text", size: int = LEXICON) -> bytes:
    """The compiled lexicon of the ``size`` most frequent words."""
    top = count_words(docs, path, text).where((F.length("word") > 0) & (F.octet_length("word") <= LONGEST)).orderBy(F.desc("n"), "word").limit(size)
    own = vocabulary(path)
    return compile_lexicon({(w := r["word"].encode("utf-8")): own.merge(w) for r in top.select("word").toLocalIterator()})


OUT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _mapped(docs: DataFrame, path: str, doc_id: str, text: str, lexicon: bytes, schema: pa.Schema, ddl: str, row) -> DataFrame:
    small_batches(docs.sparkSession)
    sent, key = docs.sparkSession.sparkContext.broadcast(lexicon), hashlib.sha256(lexicon).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_by_worker(("bpe", path, key), lambda: Encoder(vocabulary(path), Lexicon(sent.value)))
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                rows = [row(encoder, x) for x in batch.column(1).to_pylist()]
                columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), list(schema)[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], schema=schema)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(run, ddl)


def encode_documents(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", lexicon: bytes | None = None) -> DataFrame:
    """``doc_id, ids`` and the text that decoding gives."""
    lexicon = build_lexicon(docs, path, text) if lexicon is None else lexicon
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    def row(encoder: Encoder, text: str) -> tuple:
        ids = np.frombuffer(encoder.encode(text), dtype="<i4")
        return ids, encoder.vocabulary.decode(ids)

    return _mapped(docs, path, doc_id, text, lexicon, schema, "doc_id long, ids array<int>, decoded string", row)


def digest_documents(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", lexicon: bytes | None = None, with_ids: bool = False) -> DataFrame:
    """Counts and digests of every document's ids and of what they decode to, and the ids where asked."""
    lexicon = build_lexicon(docs, path, text) if lexicon is None else lexicon
    more = [("ids", pa.list_(pa.int32()))] if with_ids else []
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), *more])

    def row(encoder: Encoder, text: str) -> tuple:
        ids = encoder.encode(text)
        numbers = np.frombuffer(ids, dtype="<i4")
        decoded = encoder.vocabulary.decode(numbers)
        out = len(numbers), hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode("utf-8")).hexdigest()
        return (*out, numbers) if with_ids else out

    return _mapped(docs, path, doc_id, text, lexicon, schema, OUT + (", ids array<int>" if with_ids else ""), row)
