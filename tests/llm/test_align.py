"""Alignment of two tokenizers against their libraries, token by token."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from auditloom.llm import align
from auditloom.llm.catalog import QUERIES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", None, " ", "  a  b\n\nc", "x\u2581y", "<|endoftext|> <s> </s> <unk>\x00", "日本語 テスト 😀😀 é\u0301", "\u00a0 nbsp", "a" * 5000, "\tif x:\n        return  1",
    " lead", "trail   ", "'s don't I'LL", "\ufeffbom", "<0x0A>", "１２３ ½", "ﬁ Å Å", "word word word", "word word word",
]


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def plain(libraries, rows):
    """``id: (n_a, n_b, n_groups, n_links, n_best, count_sum, digest)`` by walking both token lists; rows as ``(id, text)``."""
    a, b = libraries
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    level = {chr(x): x for x in shown} | {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in shown)}
    of_a = lambda i: bytes(level[c] for c in a.id_to_token(i))
    of_b = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("\u2581", " ").encode()
    made, counts = [], Counter()
    for key, text in rows:
        ids_a, ids_b = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        if b"".join(map(of_a, ids_a)) != b"".join(map(of_b, ids_b)) or (text and b"".join(map(of_b, ids_b)) != (" " + text).encode()):
            ids_a, ids_b = [], []
        ends_a, ends_b = (np.cumsum([len(of(i)) for i in ids]).tolist() for of, ids in ((of_a, ids_a), (of_b, ids_b)))
        links = []
        for i, x in enumerate(ids_a):
            low, high = (ends_a[i - 1] if i else 0), ends_a[i]
            links += [(x, y) for j, y in enumerate(ids_b) if (ends_b[j - 1] if j else 0) < high and ends_b[j] > low] if len(ids_a) < 60 else []
        if len(ids_a) >= 60:  # the same by a walk
            i = j = 0
            while i < len(ids_a):
                links.append((ids_a[i], ids_b[j]))
                step_a, step_b = ends_a[i] <= ends_b[j], ends_b[j] <= ends_a[i]
                i, j = i + step_a, j + step_b
        groups, at_a, at_b = [], 0, 0
        for end in sorted({*ends_a} & {*ends_b}):
            to_a, to_b = ends_a.index(end, at_a) + 1, ends_b.index(end, at_b) + 1
            groups.append(",".join(map(str, ids_a[at_a:to_a])) + "|" + ",".join(map(str, ids_b[at_b:to_b])))
            at_a, at_b = to_a, to_b
        counts.update(links)
        made.append((key, len(ids_a), len(ids_b), groups, links))
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return Counter(
        (key, n_a, n_b, len(groups), len(links), sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
        for key, n_a, n_b, groups, links in made
    )


def test_query(spark, sf, libraries):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert Counter(map(tuple, QUERIES["op11_token_alignment"](spark, sf).collect())) == plain(libraries, rows)


def test_odd_texts_and_string_ids(spark, libraries):
    rows = [(None if i == 3 else f"d{i % 7}", x) for i, x in enumerate(ODD)]
    docs = spark.createDataFrame([(k, x, 1, 2) for k, x in rows], "doc_id string, text string, chunk int, pairs int").repartition(3)
    want = plain(libraries, rows)
    assert Counter(map(tuple, align.align_documents(docs, A, B).collect())) == want
    assert sum(n for k, n in want.items() if k[1] == 0) == 3  # null, empty and the blank's own sign


def test_empty(spark):
    out = align.align_documents(spark.createDataFrame([], "doc_id long, text string"), A, B)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert out.count() == 0


def test_blocks_don_t_change_links(libraries, monkeypatch):
    aligner = align.Aligner(A, B)
    texts = ["one two", None, "three  four\n", "naïve"]
    counts, digests, pairs, first = aligner.align(texts)
    for i, x in enumerate(texts):
        one, digest, own, _ = aligner.align([x])
        assert digest == [digests[i]] and all(one[k][0] == counts[k][i] for k in one)
        assert own.tolist() == pairs[first[i] : first[i + 1]].tolist()


def test_packed_numbers():
    for x in ([], [0], [0, 1, 70000, 1 << 31]):
        assert align.unpack(align.pack(np.array(x, dtype=np.int64))).tolist() == x
