"""Regressions against numpy on the same rows."""

import math

import numpy as np
import pytest

from auditloom.operators import regress


def rows(n=600, seed=4):
    rng = np.random.default_rng(seed)
    a, b, g = rng.normal(1000, 30, n), rng.normal(size=n), rng.integers(0, 25, n)
    eta = -0.4 + 0.02 * (a - 1000) + 0.8 * b + 0.3 * rng.normal(size=25)[g]
    y, hit, times = 3 + 2 * a - 5 * b + rng.normal(size=25)[g] * 4 + rng.normal(size=n), (rng.random(n) < 1 / (1 + np.exp(-eta))).astype(float), rng.poisson(np.exp(eta / 2)).astype(float)
    return a, b, g, y, hit, times


@pytest.fixture(scope="module")
def table(spark):
    a, b, g, y, hit, times = rows()
    data = [tuple(map(float, r[:2])) + (f"g{r[2]}",) + tuple(map(float, r[3:])) for r in zip(a, b, g, y, hit, times, strict=True)]
    odd = [(None, 1.0, "g1", 1.0, 1.0, 1.0), (float("nan"), 1.0, "g1", 1.0, 1.0, 1.0), (1.0, float("inf"), "g1", 1.0, 0.0, 1.0), (1.0, 1.0, "g1", None, None, None)]
    return spark.createDataFrame(data + odd, "a double, b double, g string, y double, hit double, times double").repartition(4)


def plain(family, y, x, g, errors):
    n, p = x.shape
    beta = np.zeros(p)
    if family == "gaussian":
        beta = np.linalg.lstsq(x, y, rcond=None)[0]
        mean, w = x @ beta, np.ones(n)
    else:
        for _ in range(60):
            mean = 1 / (1 + np.exp(-x @ beta)) if family == "binomial" else np.exp(x @ beta)
            w = mean * (1 - mean) if family == "binomial" else mean
            step = np.linalg.solve((x * w[:, None]).T @ x, x.T @ (y - mean))
            beta = beta + step / max(1, np.abs(x @ step).max() / 5)
        mean = 1 / (1 + np.exp(-x @ beta)) if family == "binomial" else np.exp(x @ beta)
        w = mean * (1 - mean) if family == "binomial" else mean
    bread, e = np.linalg.inv((x * w[:, None]).T @ x), y - mean
    if errors == "clustered":
        u = np.array([(x * e[:, None])[g == k].sum(0) for k in sorted(set(g))])
        cov = len(u) / (len(u) - 1) * ((n - 1) / (n - p) if family == "gaussian" else 1) * bread @ u.T @ u @ bread
    elif errors == "robust":
        u = x * e[:, None]
        cov = n / (n - p) * bread @ u.T @ u @ bread
    else:
        cov = bread * (e @ e / (n - p) if family == "gaussian" else 1)
    return beta, np.sqrt(np.diag(cov))


@pytest.mark.parametrize("errors", ["classical", "robust", "clustered"])
@pytest.mark.parametrize("family", regress.FAMILIES)
def test_against_numpy(spark, table, family, errors):
    a, b, g, y, hit, times = rows()
    x = np.column_stack([np.ones(len(a)), a, b])
    own = {"gaussian": y, "binomial": hit, "poisson": times}[family]
    found = regress.fit(table, {"gaussian": "y", "binomial": "hit", "poisson": "times"}[family], ["a", "b"], family=family, errors="robust" if errors == "robust" else "classical", cluster="g" if errors == "clustered" else None)
    beta, se = plain(family, own, x, g, errors)
    assert found.n == 600 and found.terms == ["(constant)", "a", "b"]
    got = {r.term: r for r in found.frame(spark).collect()}
    for t, want, s in zip(found.terms, beta, se, strict=True):
        assert got[t].estimate == pytest.approx(want, rel=1e-6) and got[t].se == pytest.approx(s, rel=1e-6)
        assert got[t].p == pytest.approx(math.erfc(abs(want / s) / math.sqrt(2)), rel=1e-4, abs=1e-12)
    if family == "gaussian":
        assert found.r2 == pytest.approx(1 - ((y - x @ beta) ** 2).sum() / ((y - y.mean()) ** 2).sum(), rel=1e-9)
    if errors == "clustered":
        assert found.clusters == 25


def test_what_cannot_be_fitted(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, 1.0, float(i % 2), float(i > 5), "one") for i in range(12)], "a double, b double, c double, y double, apart double, g string")
    for y, xs, more in (("y", ["a", "b"], {}), ("y", ["c"], {}), ("apart", ["a"], {"family": "binomial"}), ("a", ["y"], {"cluster": "g"}), ("a", ["y"], {"family": "binomial"}), ("y", ["a"], {"family": "what"})):
        with pytest.raises(ValueError):
            regress.fit(df, y, xs, **more)
    with pytest.raises(ValueError):
        regress.fit(df.limit(0), "y", ["a"])
