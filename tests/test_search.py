"""Search over an index and nearest neighbours against plain scans."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from auditloom.operators import neighbours, search


def words(text):
    return [w for w in re.split("[^a-z0-9]+", (text or "").lower()) if w]


def plain_search(docs, queries, k):
    held = {i: Counter(words(x)) for i, x in docs if i is not None and words(x)}
    mean = sum(sum(c.values()) for c in held.values()) / len(held)
    df = Counter(t for c in held.values() for t in c)
    out = set()
    for q, text in queries:
        scores = []
        for i, c in held.items():
            dl = sum(c.values())
            parts = [math.log(1 + (len(held) - df[t] + 0.5) / (df[t] + 0.5)) * c[t] * 2.2 / (c[t] + 1.2 * (0.25 + 0.75 * dl / mean)) for t in set(words(text)) if t in c]
            if parts:
                scores.append((-round(sum(parts), 6), i))
        out |= {(q, i, -s, r + 1) for r, (s, i) in enumerate(sorted(scores)[:k])}
    return out


def got(df):
    return {(r.query, r.key, round(r.score, 6), r["rank"]) for r in df.collect()}


DOCS = [(f"k{i:03d}", " ".join(f"w{(i * j) % 37}" for j in range(1, 4 + i % 23))) for i in range(400)] + [("null", None), ("blank", " -- "), (None, "w1 w2"), ("long", "w1 rare " * 30_000), ("copy", "w1 rare " * 30_000)]
QUERIES = [("a", "w1 w5 w36"), ("b", "rare"), ("c", "W1, w1; unheard"), ("d", "unheard"), ("e", ""), ("f", None), ("g", " ".join(f"w{i}" for i in range(37)))]


@pytest.mark.parametrize("asked", [QUERIES, QUERIES[:1], [("many", " ".join(f"w{i} x{i}" for i in range(200)))]])
def test_search(spark, asked):
    docs = spark.createDataFrame(DOCS, "key string, text string").repartition(3)
    index = search.build_index(docs, "key")
    assert index.n == 402
    out = search.search(index, spark.createDataFrame(asked, "query string, text string"), 5)
    assert got(out) == plain_search(DOCS, asked, 5)
    again = search.open_index(spark, index.path)
    assert again == index


def test_a_search_reads_little(spark):
    """Of a few terms only their folders are opened, and of their files only the pages that can hold them."""
    text = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(40)), lambda i: F.concat(F.lit("t"), F.pmod(F.xxhash64("key", i), F.lit(50_000)))), " ")
    index = search.build_index(spark.range(6_000).select(F.col("id").alias("key"), text.alias("text")), "key")
    postings = index.postings(spark)
    every = postings.select("term", "keys")
    some = search._some(postings, [(r["term"], r["folder"]) for r in postings.where("term IN ('t7', 't4711', 't40000')").select("term", "folder").distinct().collect()]).select("term", "keys")
    assert {r["term"] for r in some.collect()} == {"t7", "t4711", "t40000"} and every.collect()
    few, all_ = scanned(some), scanned(every)
    assert few["filesSize"] < all_["filesSize"] / 8 and few["numOutputRows"] < all_["numOutputRows"] / 40


def scanned(df):
    """What the one scan of a plan that has run has read."""
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    metrics = leaves.apply(0).metrics()
    return {k: metrics.apply(k).value() for k in ("filesSize", "numOutputRows")}


MANY = [(f"q{i}", " ".join(f"w{i * j % 41} x{i * j}" for j in range(30))) for i in range(40)]


def test_a_search_for_many_terms_meets_parts(spark, monkeypatch):
    """Several parts and several blocks of queries, with texts that tie across parts."""
    monkeypatch.setattr(search, "PART", 1 << 10, raising=False)
    monkeypatch.setattr(search, "QUERIES", 7, raising=False)
    docs = [(10 * i, f"w1 w2 w{i % 5}") for i in range(200)] + [(10 * i + 1, " ".join(f"w{i * j % 43}" for j in range(1 + i % 30))) for i in range(300)]
    index = search.build_index(spark.createDataFrame(docs, "key long, text string").repartition(3), "key")
    out = search.search(index, spark.createDataFrame(MANY, "query string, text string"), 6)
    assert got(out) == plain_search(docs, MANY, 6)


def test_a_search_for_many_terms_moves_little(spark):
    """What is shuffled grows with the documents' terms, not with the pairs of queries and documents."""
    docs = spark.range(2_000).select("id", F.array_join(F.transform(F.sequence(F.lit(1), F.lit(30)), lambda j: F.concat(F.lit("w"), F.pmod(F.xxhash64("id", j), F.lit(41)))), " ").alias("text"))
    moved = lambda: spark._jsc.sc().statusStore().executorList(True).apply(0).totalShuffleWrite()
    asked = [(f"{q}-{k}", x) for q, x in MANY for k in range(6)]
    before = moved()
    index = search.build_index(docs, "id")
    assert search.search(index, spark.createDataFrame(asked, "query string, text string"), 5).count() == 5 * len(asked)
    assert moved() - before < 1_200_000


def test_empty_index(spark):
    index = search.build_index(spark.createDataFrame([("a", None)], "key string, text string"), "key")
    assert index.n == 0 and search.search(index, spark.createDataFrame(QUERIES, "query string, text string")).count() == 0


def plain_nearest(rows, k):
    good = [(i, np.array(v, dtype=float)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = set()
    by = defaultdict(list)
    for i, v in good:
        by[len(v)].append((i, v / np.sqrt((v * v).sum())))
    for some in by.values():
        for i, a in some:
            scores = sorted((-round(float(a @ b), 6) + 0.0, j) for j, b in some if j != i)[:k]
            out |= {(i, j, -s, r + 1) for r, (s, j) in enumerate(scores)}
    return out


def test_nearest(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CELL", 20)
    monkeypatch.setattr(neighbours, "NEAR", 2)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 5))
    rows = [(i, (centres[i % 6] + 0.1 * rng.normal(size=5)).tolist()) for i in range(300)]
    rows += [(1000 + i, [1.0, 2.0, 0.0, 0.0, 1.0]) for i in range(40)] + [(2000 + i, [2.0, 4.0, 0.0, 0.0, 2.0]) for i in range(3)]
    rows += [(3000, None), (3001, []), (3002, [0.0] * 5), (3003, [1.0, None, 0.0, 0.0, 0.0]), (3004, [float("nan")] * 5), (3005, [float("inf")] * 5), (None, [1.0] * 5), (3006, [1.0, 2.0]), (3007, [2.0, 1.0]), (3008, [5.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    out = {(r.vec_id, r.other, round(r.score, 6) + 0.0, r["rank"]) for r in neighbours.nearest(df, 4).collect()}
    want = plain_nearest(rows, 4)
    assert {(a, b, r) for a, b, _, r in out} == {(a, b, r) for a, b, _, r in want}
    assert neighbours.nearest(df.limit(0), 4).count() == 0


def test_a_block_keeps_its_best_over_many():
    """What a block keeps while others meet it is what one comparison with all of them gives; floors known before leave nothing out."""
    rng = np.random.default_rng(4)
    unit = rng.normal(size=(300, 6))
    unit[200:230] = unit[0]
    unit /= np.sqrt((unit * unit).sum(1))[:, None]
    names, k = rng.permutation(300), 7
    want = {}
    for i, scores in enumerate(np.round(unit @ unit.T, neighbours.DIGITS)):
        want[i] = sorted(zip(-scores, names, strict=True))[:k]
    floors = np.array([-want[i][-1][0] for i in range(300)])
    for floor in (np.full(300, -np.inf), floors, np.where(np.arange(300) % 2, floors, -np.inf)):
        best = neighbours._Best(unit, floor.copy(), k)
        for at in range(0, 300, 13):
            best.meet(names[at : at + 13], unit[at : at + 13])
        kept = {i: sorted(zip(-np.round(best.score[best.row == i], neighbours.DIGITS), best.name[best.row == i], strict=True)) for i in range(300)}
        assert kept == want
