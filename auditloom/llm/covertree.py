"""Embedding near-duplicates: exact threshold pairs by dual traversal of cover trees.

Vectors of one label are unit-scaled; cosine at least ``threshold`` is a distance of at
most ``r = sqrt(2 - 2 threshold)``. Equal vectors become one weighted point. Large labels
are dealt into cells round pivots; a point also visits every cell in which a neighbour can
lie (its distance to the separating plane is at most r). Cells are cut into blocks of at
most ``BLOCK`` points, so a task holds two blocks whatever a label's size. In a task, one
cover tree stands over the visiting points and one over the block's own: levels nest,
radii halve, and a pair of nodes is dropped, or counted as a whole, by the bounds that
their covering radii give.

Pairs are not written out: a task gives each point's number of links, and a forest of
links from which components follow.

Defined results: a vector that is null, zero, or has null or non-finite components, or
whose label or id is null, links with nothing; vectors of different lengths don't link;
repeated rows are vectors of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditloom.llm.common import components, cut, tidy

BLOCK = 4096
#: All pivots together; bounds what is broadcast, while blocks bound what a task holds.
PIVOTS = 2048
#: Bounds are loosened by this much, so rounding never drops a pair: near zero a distance
#: made from a cosine is off by up to the root of twice the rounding error, about 3e-8.
SLACK = 1e-7


class CoverTree:
    """Nodes as arrays; a node's points are ``order[low:high]``, its children ``kids[first:last]``."""

    def __init__(self, points: np.ndarray) -> None:
        self.points = points
        self.center, self.cover, self.low, self.high, self.children = [], [], [], [], []
        self.order: list[int] = []
        if len(points):
            self._build()
        self.center, self.cover = np.array(self.center, dtype=np.int64), np.array(self.cover)
        self.low, self.high = np.array(self.low, dtype=np.int64), np.array(self.high, dtype=np.int64)
        self.order = np.array(self.order, dtype=np.int64)

    def _node(self, center: int, cover: float) -> int:
        self.center.append(center)
        self.cover.append(cover)
        self.low.append(0)
        self.high.append(0)
        self.children.append(None)
        return len(self.center) - 1

    def _build(self) -> None:
        def apart(i: int, members: np.ndarray) -> np.ndarray:
            return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (self.points[members] @ self.points[i])))

        everyone = np.arange(len(self.points))
        far = apart(0, everyone)
        root = self._node(0, float(far.max()))
        # Depth first; a node is left once its children are, which gives points in order.
        todo = [(root, everyone, far, 2.0, False)]
        while todo:
            node, members, away, radius, done = todo.pop()
            if done:
                self.high[node] = len(self.order)
                continue
            self.low[node] = len(self.order)
            if len(members) == 1:
                self.order.append(int(members[0]))
                self.high[node] = len(self.order)
                continue
            todo.append((node, members, away, radius, True))
            # The largest halved radius that splits the node: levels that would repeat it are skipped.
            radius /= 2
            while radius >= self.cover[node] > 0:
                radius /= 2
            if self.cover[node] == 0:
                parts = [(int(i), np.array([i]), np.zeros(1)) for i in members]
            else:
                parts, center = [], self.center[node]
                while len(members):
                    inside = away <= radius
                    inside[members == center] = True
                    parts.append((center, members[inside], away[inside]))
                    members = members[~inside]
                    if len(members):
                        center = int(members[0])
                        away = apart(center, members)
            kids = []
            for center, own, d in parts:
                kid = self._node(center, float(d.max()) if len(own) > 1 else 0.0)
                kids.append(kid)
                todo.append((kid, own, d, radius, False))
            self.children[node] = np.array(kids, dtype=np.int64)

    def expand(self, node: int) -> np.ndarray:
        return np.array([node]) if self.children[node] is None else self.children[node]


class _Forest:
    def __init__(self, n: int) -> None:
        self.root = np.arange(n)
        self.u: list[int] = []
        self.v: list[int] = []

    def join(self, i: int, others: np.ndarray) -> None:
        roots, where = np.unique(self.root[others], return_index=True)
        for other, at in zip(roots.tolist(), where.tolist(), strict=True):
            mine = int(self.root[i])
            if other != mine:
                self.u.append(i)
                self.v.append(int(others[at]))
                low, high = min(mine, other), max(mine, other)
                self.root[self.root == high] = low


def dual_links(queries: np.ndarray, data: np.ndarray, weights: np.ndarray, threshold: float) -> tuple[np.ndarray, list[int], list[int]]:
    """Each query's summed weight of data points within the threshold, and a forest of links.

    The forest's nodes are queries by number and data points by number after them.
    """
    a, b = CoverTree(queries), CoverTree(data)
    r, nq = float(np.sqrt(2.0 - 2.0 * threshold)), len(queries)
    counts, forest = np.zeros(nq, dtype=np.int64), _Forest(nq + len(data))
    total = np.concatenate([[0], np.cumsum(weights[b.order])])
    leaf_a = np.array([c is None for c in a.children])
    leaf_b = np.array([c is None for c in b.children])
    todo = [(0, 0)] if nq and len(data) else []
    while todo:
        x, y = todo.pop()
        left, right = a.expand(x), b.expand(y)
        for at in range(0, len(left), 512):
            rows = left[at : at + 512]
            cosine = queries[a.center[rows]] @ data[b.center[right]].T
            away = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosine))
            reach = a.cover[rows][:, None] + b.cover[right][None, :]
            ends = leaf_a[rows][:, None] & leaf_b[right][None, :]
            hit = ends & (cosine >= threshold)
            full = ~ends & (away + reach <= r - SLACK)
            rest = ~ends & ~full & (away <= r + reach + SLACK)
            if hit.any():
                weigh = weights[b.center[right]]
                counts[a.center[rows]] += hit @ weigh
                for i in np.nonzero(hit.any(axis=1))[0]:
                    forest.join(int(a.center[rows[i]]), nq + b.center[right[np.nonzero(hit[i])[0]]])
            for i, j in zip(*np.nonzero(full), strict=True):
                p, q = int(rows[i]), int(right[j])
                own, other = a.order[a.low[p] : a.high[p]], nq + b.order[b.low[q] : b.high[q]]
                counts[own] += total[b.high[q]] - total[b.low[q]]
                for o in own.tolist():
                    forest.join(o, other)
            todo += [(int(rows[i]), int(right[j])) for i, j in zip(*np.nonzero(rest), strict=True)]
    return counts, forest.u, forest.v


def unit_vectors(vectors: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    """``vec_id, label, dim, key, unit``; key and unit are null where a vector links with nothing."""
    schema = pa.schema([("vec_id", pa.int64()), ("label", pa.string()), ("dim", pa.int32()), ("key", pa.binary()), ("unit", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, x, group in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out = {"vec_id": i, "label": group, "dim": None, "key": None, "unit": None}
                if x and i is not None and group is not None and None not in x:
                    v = np.array(x, dtype=np.float64)
                    size = np.abs(v).max()
                    if np.isfinite(size) and size > 0:
                        # Scaled first, so neither very large nor very small components overflow.
                        u = v / size
                        unit = (u / np.sqrt(u @ u)).astype("<f8").tobytes()
                        out |= {"dim": len(v), "key": hashlib.blake2b(unit, digest_size=16).digest(), "unit": unit}
                rows.append(out)
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    columns = [F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"), F.col(label).cast("string").alias("label")]
    return vectors.select(*columns).mapInArrow(run, "vec_id long, label string, dim int, key binary, unit binary")


def _sample_pivots(points: DataFrame, sizes: DataFrame, block: int) -> dict[tuple[str, int], np.ndarray]:
    """Seeded pivots of the largest labels, PIVOTS in all at most."""
    large = sizes.where(F.col("m") > block).orderBy(F.desc("m"), "label", "dim").limit(PIVOTS // 2).collect()
    total, found, left = sum(r["m"] for r in large), {}, PIVOTS
    for row in large:
        n = min(left, max(2, round(PIVOTS * row["m"] / total)), -(-row["m"] // (block // 2)))
        if n >= 2:
            found[row["label"], row["dim"]] = (n, row["m"])
            left -= n
    if not found:
        return {}
    # About twice the wanted number by hash range, then the least hashes of each label.
    asked = points.sparkSession.createDataFrame([(k[0], k[1], n, min(1.0, 2.0 * n / m + 16.0 / m)) for k, (n, m) in found.items()], "label string, dim int, n int, part double")
    h = F.pmod(F.xxhash64("key"), F.lit(1 << 30)) / float(1 << 30)
    some = points.join(F.broadcast(asked), ["label", "dim"]).withColumn("h", h).where("h < part").select("label", "dim", "h", "unit").collect()
    out: dict = {}
    for r in sorted(some, key=lambda r: (r["label"], r["dim"], r["h"])):
        out.setdefault((r["label"], r["dim"]), []).append(np.frombuffer(bytes(r["unit"]), dtype="<f8"))
    return {k: np.array(v[: found[k][0]]) for k, v in out.items() if len(v) >= 2}


def _visits(points: DataFrame, pivots: dict, r: float) -> DataFrame:
    """``points`` with ``home`` and the ``cells`` that each one visits, its own included."""
    sent = points.sparkSession.sparkContext.broadcast(pivots)
    schema = pa.schema([("label", pa.string()), ("dim", pa.int32()), ("cid", pa.int64()), ("n", pa.int64()), ("unit", pa.binary()), ("home", pa.int32()), ("cells", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups, dims, units = (batch.column(i).to_pylist() for i in (0, 1, 4))
            home, cells = [0] * len(groups), [[0] for _ in groups]
            where: dict = {}
            for i, k in enumerate(zip(groups, dims, strict=True)):
                where.setdefault(k, []).append(i)
            for k, rows in where.items():
                p = sent.value.get(k)
                if p is None:
                    continue
                between = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (p @ p.T)))
                for at in range(0, len(rows), 1024):
                    some = rows[at : at + 1024]
                    cosine = np.array([np.frombuffer(units[i], dtype="<f8") for i in some]) @ p.T
                    near = cosine.argmax(axis=1)
                    # Twice the distance to the plane between two pivots, times theirs.
                    gap = 2.0 * (cosine[np.arange(len(some)), near][:, None] - cosine)
                    open_cells = gap <= 2.0 * r * between[near] + SLACK
                    for i, h, o in zip(some, near.tolist(), open_cells, strict=True):
                        home[i], cells[i] = h, np.nonzero(o)[0].tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(home, pa.int32()), pa.array(cells, pa.list_(pa.int32()))], schema=schema)

    return points.select("label", "dim", "cid", "n", "unit").mapInArrow(run, "label string, dim int, cid long, n long, unit binary, home int, cells array<int>")


def near_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", threshold: float = 0.98, block: int = BLOCK) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row; a row without an id has no component."""
    with tidy() as keep:
        units = keep(cut(unit_vectors(vectors, vec_id, embedding, label), "units"))
        valid = units.where("key IS NOT NULL")
        points = valid.groupBy("label", "dim", "key").agg(F.min("vec_id").alias("low"), F.count("*").alias("n"), F.first("unit").alias("unit"))
        # A distinct vector of a label is a point, numbered once for all as it is written.
        points = cut(points.withColumn("cid", F.monotonically_increasing_id()), "points")
        sizes = points.groupBy("label", "dim").agg(F.count("*").alias("m"))
        placed = cut(_visits(points, _sample_pivots(points, sizes, block), float(np.sqrt(2.0 - 2.0 * threshold))), "placed")
        cell = ["label", "dim", "cell"]
        data = placed.select("label", "dim", F.col("home").alias("cell"), "cid", "n", "unit")
        asking = placed.select("label", "dim", F.explode("cells").alias("cell"), "cid", "n", "unit")
        blocks = lambda n: F.ceil(F.col(n) / float(block)).cast("int")
        plan = data.groupBy(*cell).agg(F.count("*").alias("nd")).join(asking.groupBy(*cell).agg(F.count("*").alias("nq")), cell)
        plan = cut(plan.select(*cell, blocks("nd").alias("bd"), blocks("nq").alias("bq")), "plan")
        h = F.xxhash64("cid")
        own = F.pmod(h, F.col("bd")).cast("int")
        asks = F.pmod(h, F.col("bq")).cast("int")
        upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
        rows = data.join(plan, cell).select(*cell, own.alias("d"), F.explode(upto("bq")).alias("q"), F.lit(False).alias("asks"), "cid", "n", "unit")
        rows = rows.union(asking.join(plan, cell).select(*cell, F.explode(upto("bd")).alias("d"), asks.alias("q"), F.lit(True).alias("asks"), "cid", "n", "unit"))

        def search(pdf: pd.DataFrame) -> pd.DataFrame:
            def table(asked: bool) -> tuple:
                part = pdf[pdf.asks == asked].sort_values("cid")
                dim = int(pdf.dim.iloc[0])
                return part.cid.to_numpy(), np.frombuffer(b"".join(part.unit), dtype="<f8").reshape(-1, dim), part.n.to_numpy()

            (qi, qx, _), (di, dx, dn) = table(True), table(False)
            counts, u, v = dual_links(qx, dx, dn, threshold)
            every = np.concatenate([qi, di])
            a, b = every[np.array(u, dtype=np.int64)], every[np.array(v, dtype=np.int64)]
            other = a != b
            return pd.DataFrame({"a": np.concatenate([qi, a[other]]), "b": np.concatenate([np.full(len(qi), -1), b[other]]), "n": np.concatenate([counts, np.full(int(other.sum()), -1)])})

        found = cut(rows.groupBy(*cell, "d", "q").applyInPandas(search, "a long, b long, n long"), "found")
        counts = found.where("n >= 0").groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("links"))
        roots = components(found.where("n < 0").select(F.col("a").alias("u"), F.col("b").alias("v"))).withColumnRenamed("node", "cid")
        rooted = points.select("label", "dim", "key", "low", "cid").join(counts, "cid").join(roots, "cid", "left")
        rooted = cut(rooted.select("label", "dim", "key", "low", "links", F.coalesce("root", "cid").alias("root")), "rooted")
        lowest = cut(rooted.groupBy("root").agg(F.min("low").alias("component_id")), "lowest")
        named = keep(cut(rooted.join(lowest, "root").select("label", "dim", "key", "links", "component_id"), "named"))
    out = units.select("vec_id", "label", "dim", "key").join(named, ["label", "dim", "key"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce(F.col("links") - 1, F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
