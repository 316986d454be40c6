"""Spelling variants against all pairs of words."""

import re
import zlib
from collections import Counter

from auditloom.llm import variants
from auditloom.llm.catalog import QUERIES

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long_ = sorted((a, b), key=len)
    return len(long_) - len(short) == 1 and any(long_[:i] + long_[i + 1 :] == short for i in range(len(long_)))


def plain(rows):
    n = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if c >= 2 and len(w) >= 7}
    near = {w: set() for w in n}
    # Two words one apart agree in all of a half: the first of equal length, or the last.
    halves = {}
    for w in n:
        for k in ((0, w[:3]), (1, w[-3:])):
            halves.setdefault(k, []).append(w)
    for some in halves.values():
        for i, a in enumerate(some):
            for b in some[:i]:
                if abs(len(a) - len(b)) < 2 and one_apart(a, b):
                    near[a].add(b)
                    near[b].add(a)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n)


def got(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()))


def test_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = plain(rows)
    assert any(w[1] for w in want) and max(w[4] for w in want) > 1
    assert got(QUERIES["op13_spelling_variants"](spark, sf)) == want


def test_chains_ties_and_long_words(spark):
    many = [("aaaaaaa", 300), ("aaaaaab", 30), ("aaaaabb", 3), ("aaaaaaaa", 300), ("zzzzzzzq", 2), ("zzzzzzz", 2), ("ñandúÉs", 40), ("ñandúés", 4), ("ÑandúÉs", 2), ("×÷ßàÿþð", 2), ("×÷ßàÿþ", 5)]
    long_ = ["c" * 64, "c" * 65, "c" * 66, "c" * 40 + "d" + "c" * 24, "x" * 70, "x" * 35 + "y" + "x" * 35, "x" * 69, "k" * 3000, "k" * 2999, "k" * 1500 + "j" + "k" * 1499]
    rows = [("r", " ".join([w] * n)) for w, n in many] + [(k, " ".join(long_)) for k in ("a", "b", None)] + [("e", None), ("f", "")]
    docs = spark.createDataFrame([(k, x, "clash") for k, x in rows], "doc_id string, text string, word string").repartition(3)
    want = plain(rows)
    assert {len(w[0]) for w in want} >= {7, 64, 65, 3000}
    assert got(variants.variants_of_texts(docs)) == want


def test_empty(spark):
    for rows in ([], [(1, None), (2, "short words only")]):
        assert variants.variants_of_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect() == []
