"""Searches by frontiers against a plain breadth-first search, and intervals against numpy."""

import hashlib
from collections import deque

import numpy as np
import pytest

from auditloom.operators import measure, retrieve


def plain_distances(edges, starts, depth=None):
    near, out = {}, {s: 0 for s in starts if s is not None}
    for a, b in edges:
        if a is not None and b is not None:
            near.setdefault(a, []).append(b)
    todo = deque(out)
    while todo:
        a = todo.popleft()
        for b in near.get(a, []):
            if b not in out and (depth is None or out[a] < depth):
                out[b] = out[a] + 1
                todo.append(b)
    return out


@pytest.mark.parametrize("depth", [None, 0, 1, 3])
def test_distances(spark, depth):
    rng = np.random.default_rng(5)
    edges = [(f"n{a}", f"n{b}") for a, b in rng.integers(0, 120, (130, 2)).tolist()] + [("n1", "n1"), ("n1", None), (None, "n2"), ("n3", "n4"), ("n3", "n4")]
    starts = ["n0", "n7", "n7", "alone", None]
    got = retrieve.distances(spark.createDataFrame(edges, "src string, dst string"), spark.createDataFrame([(s,) for s in starts], "id string"), depth)
    assert {r.id: r.steps for r in got.collect()} == plain_distances(edges, starts, depth)


def test_distances_of_nothing(spark):
    edges, starts = spark.createDataFrame([(1, 2)], "src long, dst long"), spark.createDataFrame([(1,)], "id long")
    assert retrieve.distances(edges, starts.limit(0)).count() == 0
    assert [tuple(r) for r in retrieve.distances(edges.limit(0), starts).collect()] == [(1, 0)]


def test_relations(spark):
    edges = spark.createDataFrame([("a", "b", "cites"), ("a", "b", "cites"), ("a", "c", "cites"), ("b", "a", "extends")], "src string, dst string, kind string")
    assert {tuple(r) for r in retrieve.relations(edges).collect()} == {("a", "cites", "out", 2), ("b", "cites", "in", 1), ("c", "cites", "in", 1), ("b", "extends", "out", 1), ("a", "extends", "in", 1)}


def test_intervals(spark):
    rng = np.random.default_rng(6)
    truth = rng.integers(0, 3, 300)
    rows = [(f"u{i}", f"l{t}", f"l{t if rng.random() < 0.7 else rng.integers(0, 3)}") for i, t in enumerate(truth)] + [("x", None, "l1"), (None, "l1", "l1"), ("y", "l2", None)]
    got = {r.measure: r for r in measure.agreement_intervals(spark.createDataFrame(rows, "k string, a string, b string"), "k", "a", "b", replicates=60, seed=9).collect()}
    whole = [r for r in rows if None not in r]
    runs = []
    for rep in range(61):
        h = [int(hashlib.md5(f"9:{rep}:{k}".encode()).hexdigest()[:8], 16) for k, _, _ in whole]
        w = np.array([1 if rep == 0 else sum(x >= s for s in measure.POISSON_STEPS) for x in h], dtype=float)
        a, b = np.array([r[1] for r in whole]), np.array([r[2] for r in whole])
        n, po = w.sum(), w[a == b].sum() / w.sum()
        sides = [(w[a == v].sum(), w[b == v].sum()) for v in ("l0", "l1", "l2")]
        pe, cc = sum(x * y for x, y in sides) / n / n, sum((x + y) * (x + y - 1) for x, y in sides)
        runs.append(((po - pe) / (1 - pe), 1 - (1 - po) / (1 - cc / (2 * n * (2 * n - 1)))))
    # A Poisson number of mean one weighs a row: mean and variance are about one.
    assert 0.8 < w.mean() < 1.2 and 0.7 < w.var() < 1.3
    for j, name in enumerate(("kappa", "alpha")):
        x = np.array([r[j] for r in runs])
        assert got[name].estimate == pytest.approx(x[0]) and got[name].n == 300
        assert (got[name].low, got[name].high) == (pytest.approx(np.quantile(x[1:], 0.025)), pytest.approx(np.quantile(x[1:], 0.975)))
        assert got[name].low < got[name].estimate < got[name].high


def test_undefined_intervals(spark):
    rows = spark.createDataFrame([("a", "x", "x"), ("b", "x", "x")], "k string, a string, b string")
    assert all(r.estimate is None and r.low is None and r.high is None for r in measure.agreement_intervals(rows, "k", "a", "b", replicates=5).collect())
    assert measure.agreement_intervals(rows.limit(0), "k", "a", "b", replicates=5).count() == 0
