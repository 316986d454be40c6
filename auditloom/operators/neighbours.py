"""Exact nearest neighbours of every vector by cosine: cells around pivots, floors that rise by round.

Equal vectors are one, with their least ids. Each vector lies in the cell of its nearest
pivot, each cell in blocks. By the triangle inequality no member of a cell is nearer to a
vector than the vector's distance to the pivot leaves over the cell's radius, so a vector
needs the cells alone that can reach what it has found: first its own, then the few nearest,
then all that are left. Blocks meet as matrices, where their groups meet: a block is sent once
a group, not once a pair, and a meeting of groups gives each vector's best few above what it
has found, never all pairs. Pivots and the cells' radii are all that every task has, bounded by
``PIVOTS``; where bounds don't prune, as in many random dimensions, every block meets every
other, and the work is that of comparing all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from auditloom.operators.order import running
from auditloom.sources.scratch import remove, written

#: Pivots at most, and vectors of a cell that make another one worth it.
PIVOTS, CELL = 256, 512
#: Vectors of a block at most, and numbers of a group of blocks, about; two groups are what a task has in memory.
BLOCK, GROUP = 2048, 1 << 21
#: Cells besides its own that a vector visits before the rest.
NEAR = 4
#: Scores are ordered as rounded to so many digits.
DIGITS = 6
SLACK = 2 * 10.0**-DIGITS


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T))


class _Best:
    """The ``k`` best others of a block's vectors, by rounded score and then name, while blocks meet it."""

    def __init__(self, unit: np.ndarray, floor: np.ndarray, k: int) -> None:
        self.unit, self.floor, self.k = unit, floor, k
        self.row, self.name, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)

    def meet(self, names: np.ndarray, unit: np.ndarray) -> None:
        scores, k, n = self.unit @ unit.T, self.k, len(names)
        open_ = np.flatnonzero(np.isneginf(self.floor))
        cut = self.floor - SLACK
        if len(open_) and n > k:
            cut[open_] = np.partition(scores[open_], n - k, axis=1)[:, n - k] - SLACK
        r, c = np.nonzero(scores >= cut[:, None])
        if not len(r):
            return
        row, name, score = np.concatenate([self.row, r]), np.concatenate([self.name, names[c]]), np.concatenate([self.score, scores[r, c]])
        rounded = np.round(score, DIGITS)
        order = np.lexsort((name, -rounded, row))
        row = row[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        last = rank == k - 1
        self.floor[row[last]] = np.maximum(self.floor[row[last]], rounded[order][last])
        keep = rank < k
        self.row, self.name, self.score = row[keep], name[order][keep], score[order][keep]


def nearest(vectors: DataFrame, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``key, other, score, rank``: the ``k`` other rows of highest cosine for every row, ties by the least key.

    Only vectors of one length are compared. A vector that is null, empty or zero, or holds a
    null, NaN or infinity, and a row of null key, have no rows and are nobody's neighbour. Keys
    are whole numbers and a row's own.
    """
    spark = vectors.sparkSession
    made: list[str] = []

    def kept(df: DataFrame, name: str) -> DataFrame:
        out, path = written(df, name)
        made.append(path)
        return out

    e = F.transform(F.col(vector), lambda x: x.cast("double"))
    rows = vectors.select(F.col(key).cast("long").alias("id"), e.alias("v")).where(
        "id IS NOT NULL AND size(v) > 0 AND NOT exists(v, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity')) AND exists(v, x -> x <> 0)"
    )
    rows = kept(rows, "rows")
    copies = kept(rows.groupBy("v").agg(F.min("id").alias("name")), "copies")
    members = kept(rows.join(copies, "v").select("id", "name"), "members")
    # Of equal vectors the k + 1 least ids can be among anybody's k best.
    order = Window.partitionBy("name").orderBy("id")
    least = members.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k + 1).groupBy("name").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    n = copies.count()
    size = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    unit = copies.select("name", F.size("v").alias("width"), F.transform("v", lambda x: x / size).alias("u"))
    sample = unit.orderBy(F.xxhash64("name"), "name").limit(min(PIVOTS, max(1, n // CELL))).collect()
    widths = [r["width"] for r in unit.select("width").distinct().limit(PIVOTS).collect()]
    pivots = {w: np.array([r["u"] for r in sample if r["width"] == w] or [[0.0] * w]) for w in widths}

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, width, u = (batch.column(i) for i in range(3))
            cell, far = np.zeros(len(names), dtype=np.int32), np.zeros(len(names))
            for w in set(width.to_pylist()):
                at = np.flatnonzero(width.to_numpy() == w)
                d = _distances(_matrix(u.take(pa.array(at)), w), pivots.get(w, np.zeros((1, w))))
                cell[at], far[at] = d.argmin(1), d.min(1)
            yield pa.RecordBatch.from_arrays([names, width, pa.array(cell), pa.array(far), u], names=["name", "width", "cell", "far", "u"])

    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = unit.mapInArrow(placed, "name long, width int, cell int, far double, u array<double>").repartitionByRange(parts, "width", "cell", "far", "name").sortWithinPartitions("width", "cell", "far", "name")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, held = TaskContext.get().partitionId(), 0, None

        def block(t: pa.Table) -> pa.RecordBatch:
            nonlocal made
            made += 1
            one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
            far, u = t["far"].to_numpy(), t["u"].combine_chunks().flatten()
            row = [pa.array([part << 32 | made]), pa.array([t["width"][0].as_py()], pa.int32()), pa.array([t["cell"][0].as_py()], pa.int32()), pa.array([far.min()]), pa.array([far.max()]), one(t["name"].combine_chunks()), one(u)]
            return pa.RecordBatch.from_arrays(row, names=["block", "width", "cell", "lo", "hi", "names", "us"])

        for batch in batches:
            t = pa.Table.from_batches([batch])
            held = t if held is None else pa.concat_tables([held, t])
            home = held["width"].to_numpy().astype(np.int64) << 32 | held["cell"].to_numpy()
            cuts = [*np.flatnonzero(np.diff(home, prepend=-1)).tolist(), held.num_rows]
            for at, end in zip(cuts, cuts[1:], strict=False):
                last = end == held.num_rows
                while end - at > BLOCK or (end > at and not last):
                    yield block(held.slice(at, min(BLOCK, end - at)))
                    at += min(BLOCK, end - at)
                if last:
                    rest = held.slice(at)
            held = rest
        if held is not None and held.num_rows:
            yield block(held)

    blocks = kept(ranged.mapInArrow(packed, "block long, width int, cell int, lo double, hi double, names array<long>, us array<double>"), "blocks")
    heads = blocks.select("block", "width", "cell", "lo", "hi")
    rings = {(r["width"], r["cell"]): (r["lo"], r["hi"]) for r in heads.groupBy("width", "cell").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).limit(2 * PIVOTS).collect()}

    # Blocks lie in groups of neighbouring cells; pairs of blocks meet where their groups do.
    values, n_blocks = blocks.agg(F.coalesce(F.sum(F.size("names").cast("long") * F.col("width")), F.lit(0)), F.count("*")).first()
    groups = max(1, -(-values // GROUP), min(spark.sparkContext.defaultParallelism, n_blocks))
    before = running(blocks.select("block", (F.size("names").cast("long") * F.col("width")).alias("n")), [F.col("block")], {"before": F.col("n")})
    homes = kept(before.select("block", F.expr(f"CAST(before * {groups} DIV {max(1, values)} AS INT)").alias("home")), "homes")
    made.append(before._scratch)

    rank = F.row_number().over(Window.partitionBy("name").orderBy(F.desc(F.round("score", DIGITS)), "other"))

    def floors_of(found: DataFrame) -> DataFrame:
        """``block, floors``: for each vector of a block the score of the last that it keeps, null where it has found fewer."""
        floors = found.withColumn("_r", rank).where(F.col("_r") == k + 1).select("name", F.col("score").alias("floor"))
        each = blocks.select("block", F.posexplode("names").alias("at", "name")).join(floors, "name", "left")
        return kept(each.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("at", "floor"))).alias("l")).select("block", F.col("l.floor").alias("floors")), "floors")

    def met(pairs: DataFrame, floors: DataFrame | None = None) -> DataFrame:
        """``name, other, score``: of pairs of blocks ``(block, with)`` what the first's vectors may keep of the second's.

        A block goes once to every group that holds blocks it meets, and what it finds there
        leaves as one list of best, above the floors.
        """
        homed = pairs.join(homes.withColumnRenamed("home", "lg"), "block").join(homes.select(F.col("block").alias("with"), F.col("home").alias("rg")), "with")
        homed = kept(homed.select("block", "with", "lg", "rg"), "pairs")
        left = homed.groupBy("block", "lg", "rg").agg(F.collect_list("with").alias("withs")).join(blocks.select("block", "width", "names", "us"), "block")
        left = left.withColumn("floors", F.lit(None).cast("array<double>")) if floors is None else left.join(floors, "block", "left")
        theirs = blocks.select(F.col("block").alias("with"), F.col("width").alias("wide"), F.col("names").alias("others"), F.col("us").alias("units"))
        right = homed.select("with", F.col("lg").alias("la"), F.col("rg").alias("ra")).distinct().join(theirs, "with")

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            def block(t: pa.Table, i: int, names: str, us: str, width: str) -> tuple[np.ndarray, np.ndarray]:
                return t[names][i].values.to_numpy(), t[us][i].values.to_numpy(zero_copy_only=False).reshape(-1, t[width][i].as_py())

            others = {w: block(right, i, "others", "units", "wide") for i, w in enumerate(right["with"].to_pylist())}
            out = []
            for i in range(left.num_rows):
                names, unit = block(left, i, "names", "us", "width")
                floor = left["floors"][i].values
                best = _Best(unit, np.full(len(names), -np.inf) if floor is None else floor.fill_null(-np.inf).to_numpy(zero_copy_only=False).copy(), k + 1)
                for w in left["withs"][i].as_py():
                    best.meet(*others[w])
                out.append((names[best.row], best.name, best.score))
            columns = [np.concatenate(x) for x in zip(*out, strict=True)] or [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
            return pa.table(dict(zip(("name", "other", "score"), columns, strict=True)))

        ours, others = (df.repartition(parts, *at).groupBy(*at) for df, at in ((left, ("lg", "rg")), (right, ("la", "ra"))))
        return ours.cogroup(others).applyInArrow(run, "name long, other long, score double")

    def visits(floors: DataFrame, nearest_only: bool) -> DataFrame:
        """``block, width, to``: cells besides its own that a block's vectors must still see, given their floors."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = set()
                for i in range(batch.num_rows):
                    block, w, own = (batch.column(j)[i].as_py() for j in range(3))
                    d = _distances(batch.column(3)[i].values.to_numpy(zero_copy_only=False).reshape(-1, w), pivots.get(w, np.zeros((1, w))))
                    floor = batch.column(4)[i].values.fill_null(-1.0).to_numpy(zero_copy_only=False)
                    reach = np.sqrt(np.maximum(0.0, 2 - 2 * (floor - SLACK))) + 1e-7
                    cells = np.array([c for ww, c in rings if ww == w])
                    lo, hi = (np.array([rings[w, c][j] for c in cells]) for j in (0, 1))
                    bound = np.maximum(d[:, cells] - hi, lo - d[:, cells])
                    need = (bound <= reach[:, None]) & (cells != own)[None, :]
                    if nearest_only:
                        bound = np.where(need, bound, np.inf)
                        need &= bound <= np.partition(bound, min(NEAR, len(cells)) - 1, axis=1)[:, min(NEAR, len(cells)) - 1 :][:, :1]
                    out |= {(block, w, c) for c in cells[need.any(axis=0)].tolist()}
                columns = [list(x) for x in zip(*out, strict=True)] or [[], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int32())], names=["block", "width", "to"])

        return blocks.join(floors, "block").select("block", "width", "cell", "us", "floors").mapInArrow(run, "block long, width int, to int")

    def pairs_of(cells: DataFrame) -> DataFrame:
        return cells.join(heads.select(F.col("block").alias("with"), "width", F.col("cell").alias("to")), ["width", "to"]).select("block", "with")

    def best_of(df: DataFrame, name: str) -> DataFrame:
        return kept(df.withColumn("_r", rank).where(F.col("_r") <= k + 1).select("name", "other", "score"), name)

    seen = heads.select("block", "width", F.col("cell").alias("to"))
    found = best_of(met(pairs_of(seen)), "found")
    for nearest_only in (True, False):
        floors = floors_of(found)
        cells = kept(visits(floors, nearest_only).join(seen, ["block", "width", "to"], "left_anti"), "cells")
        found = best_of(found.union(met(pairs_of(cells), floors)), "found")
        seen = seen.union(cells.select("block", "width", "to"))
    # Vectors to ids: the k + 1 best ids of every distinct vector, less the row's own.
    ids = found.join(least.withColumnRenamed("name", "other"), "other").select("name", F.round("score", DIGITS).alias("score"), F.explode("ids").alias("other"))
    by = F.row_number().over(Window.partitionBy("name").orderBy(F.desc("score"), "other"))
    lists = ids.withColumn("_r", by).where(F.col("_r") <= k + 1).groupBy("name").agg(F.sort_array(F.collect_list(F.struct("_r", "other", "score"))).alias("l"))
    own = members.join(lists, "name").select("id", F.slice(F.filter("l", lambda x: x["other"] != F.col("id")), 1, k).alias("l"))
    out, _ = written(own.select(F.col("id").alias(key), F.posexplode("l").alias("p", "x")).select(key, F.col("x.other").alias("other"), F.col("x.score").alias("score"), (F.col("p") + 1).cast("long").alias("rank")), "nearest")
    for path in made:
        remove(spark, path)
    return out
