"""Regression with several regressors: sums over the rows as one aggregate, small matrices in the driver.

A pass over the rows makes all sums that a step needs, combined before they move; what
reaches the driver is one row of about the square of the number of terms, whatever the rows.
Least squares takes one pass for the coefficients and one for robust or clustered errors; the
logit and the count model take a pass a round of Newton's method, until no coefficient moves.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FAMILIES = ("gaussian", "binomial", "poisson")
CONSTANT = "(constant)"


@dataclass
class Fit:
    """Coefficients with their covariance, and what they were fitted on; the count model's likelihood leaves out what depends on ``y`` alone."""

    family: str
    terms: list[str]
    estimate: np.ndarray
    covariance: np.ndarray
    n: int
    clusters: int | None = None
    rounds: int = 1
    log_likelihood: float | None = None
    r2: float | None = None
    x: list[Column] = field(default_factory=list, repr=False)

    def frame(self, spark: SparkSession) -> DataFrame:
        """``term, estimate, se, statistic, p``: p is two-sided under the normal distribution."""
        se = np.sqrt(np.maximum(np.diag(self.covariance), 0.0))
        rows = []
        for t, b, s in zip(self.terms, self.estimate.tolist(), se.tolist(), strict=True):
            z = b / s if s > 0 else None
            rows.append((t, b, s, z, math.erfc(abs(z) / math.sqrt(2)) if z is not None else None))
        return spark.createDataFrame(rows, "term string, estimate double, se double, statistic double, p double")

    def linear(self) -> Column:
        """The linear predictor as a column."""
        out = F.lit(0.0)
        for b, x in zip(self.estimate.tolist(), self.x, strict=True):
            out = out + F.lit(b) * x
        return out


def _complete(df: DataFrame, y: str, xs: list[str], more: list[str]) -> DataFrame:
    """The columns in use as doubles; rows in which one is null or not finite are left out."""
    double = [F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(xs)]
    rows = df.select(F.col(y).cast("double").alias("_y"), *double, *[F.col(c).alias(f"_m{i}") for i, c in enumerate(more)])
    for c in ["_y", *[f"_x{i}" for i in range(len(xs))]]:
        rows = rows.where(F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) != float("inf")))
    return rows.dropna(subset=[f"_m{i}" for i in range(len(more))]) if more else rows


def _sums(rows: DataFrame, x: list[Column], weight: Column, y: Column, others: dict[str, Column]) -> tuple[np.ndarray, np.ndarray, dict[str, float]]:
    """Weighted products of the terms, of the terms with ``y``, and further sums, in one aggregate."""
    p = len(x)
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    aggs = [F.sum(weight * x[i] * x[j]).alias(f"g{i}_{j}") for i, j in pairs] + [F.sum(x[i] * y).alias(f"s{i}") for i in range(p)] + [F.sum(v).alias(k) for k, v in others.items()]
    got = rows.agg(F.count("*").alias("n"), *aggs).first()
    gram, side = np.zeros((p, p)), np.array([got[f"s{i}"] or 0.0 for i in range(p)], dtype=float)
    for i, j in pairs:
        gram[i, j] = gram[j, i] = got[f"g{i}_{j}"] or 0.0
    return gram, side, {"n": got["n"], **{k: got[k] or 0.0 for k in others}}


def _inverse(gram: np.ndarray, terms: list[str]) -> np.ndarray:
    """The inverse, after scaling to a unit diagonal; terms that others determine raise an error."""
    scale = np.sqrt(np.diag(gram))
    if (scale == 0).any():
        raise ValueError(f"no variation in {[t for t, s in zip(terms, scale, strict=True) if s == 0]}")
    unit = gram / np.outer(scale, scale)
    if np.linalg.cond(unit) > 1e13:
        raise ValueError(f"terms determine one another: {terms}")
    return np.linalg.inv(unit) / np.outer(scale, scale)


def _meat(rows: DataFrame, x: list[Column], error: Column, cluster: str | None) -> tuple[np.ndarray, int | None]:
    """Products of the scores, summed over rows, or over clusters of summed scores."""
    scores = rows.select(*[(xi * error).alias(f"u{i}") for i, xi in enumerate(x)], *([cluster] if cluster else []))
    if cluster:
        scores = scores.groupBy(cluster).agg(*[F.sum(f"u{i}").alias(f"u{i}") for i in range(len(x))])
    u = [F.col(f"u{i}") for i in range(len(x))]
    gram, _, got = _sums(scores, u, F.lit(1.0), F.lit(0.0), {})
    return gram, got["n"] if cluster else None


def fit(df: DataFrame, y: str, xs: list[str], family: str = "gaussian", errors: str = "classical", cluster: str | None = None, max_rounds: int = 50, tolerance: float = 1e-10) -> Fit:
    """``y`` on a constant and ``xs``; ``errors`` are classical or robust, or clustered by a column.

    Rows with a null or a number that isn't finite in a column in use are left out. Fewer rows
    than terms, a term without variation or one that others determine, a logit that has its
    classes apart, and one cluster alone raise an error.
    """
    if family not in FAMILIES or errors not in ("classical", "robust"):
        raise ValueError(f"unknown family {family!r} or errors {errors!r}")
    rows = _complete(df, y, xs, [cluster] if cluster else [])
    terms, x, own = [CONSTANT, *xs], [F.lit(1.0), *[F.col(f"_x{i}") for i in range(len(xs))]], F.col("_y")
    p = len(terms)
    if family == "gaussian":
        gram, side, got = _sums(rows, x, F.lit(1.0), own, {"yy": own * own, "y": own})
        n, rounds, likelihood = got["n"], 1, None
        if n <= p:
            raise ValueError(f"{n} rows for {p} terms")
        bread = _inverse(gram, terms)
        beta = bread @ side
    else:
        mean = (lambda eta: 1 / (1 + F.exp(-eta))) if family == "binomial" else F.exp
        weight = (lambda m: m * (1 - m)) if family == "binomial" else (lambda m: m)
        beta, n, likelihood = np.zeros(p), None, None
        for rounds in range(1, max_rounds + 1):
            eta = Fit(family, terms, beta, np.eye(p), 0, x=x).linear()
            m = mean(eta)
            part = own * eta - F.log1p(F.exp(-F.abs(eta))) - F.greatest(eta, F.lit(0.0)) if family == "binomial" else own * eta - m
            gram, side, got = _sums(rows, x, weight(m), own - m, {"l": part, "bad": F.when((own < 0) | ((own > 1) if family == "binomial" else F.lit(False)), 1).otherwise(0)})
            n, likelihood = got["n"], got["l"]
            if n <= p:
                raise ValueError(f"{n} rows for {p} terms")
            if got["bad"]:
                raise ValueError(f"{y} has values that {family} doesn't allow")
            bread = _inverse(gram, terms)
            step = bread @ side
            # No step changes a linear predictor by more than about five: far starts don't run off.
            reach = float(np.sqrt(np.abs(step @ gram @ step) / max(1e-300, float(gram[0, 0]))))
            beta = beta + step * min(1.0, 5.0 / reach if reach > 0 else 1.0)
            if np.abs(step).max() <= tolerance * (1 + np.abs(beta).max()):
                break
        else:
            raise ValueError(f"no convergence in {max_rounds} rounds: the classes may be apart")
    out = Fit(family, terms, beta, bread, n, rounds=rounds, log_likelihood=likelihood, x=x)
    if family == "gaussian":
        error = own - out.linear()
        rss = max(0.0, rows.agg(F.sum(error * error)).first()[0])
        tss = got["yy"] - got["y"] ** 2 / n
        out.r2, sigma2 = (1 - rss / tss if tss > 0 else None), rss / (n - p)
        out.log_likelihood = -n / 2 * (math.log(2 * math.pi * rss / n) + 1) if rss > 0 else None
    else:
        error, sigma2 = own - mean(out.linear()), 1.0
    if cluster or errors == "robust":
        meat, clusters = _meat(rows, x, error, "_m0" if cluster else None)
        if cluster and clusters < 2:
            raise ValueError("one cluster alone")
        # Small-sample factors: the usual ones for clusters and for rows.
        factor = clusters / (clusters - 1) * ((n - 1) / (n - p) if family == "gaussian" else 1.0) if cluster else n / (n - p)
        out.covariance, out.clusters = factor * bread @ meat @ bread, clusters
    else:
        out.covariance = sigma2 * bread
    return out
