"""Plumbing shared by the training-data operators: scratch tables, global order, components.

Columns whose names start with ``_al_`` are reserved for internal use.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import hashlib
import inspect
import io
import sys
import threading
import uuid
from collections.abc import Callable, Iterable, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from auditloom.llm import store
from auditloom.sources.scratch import remove, scratch_path, scratch_root, written  # noqa: F401

WORD = r"[^\x20\x09-\x0D]+"


_held: dict = {}


def release() -> None:
    """Give freed memory back to the system, which neither Arrow's pool nor C's allocator does by itself."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def kept_by_worker(key: tuple, make):
    """What a Python worker keeps from task to task: one operator's cache at a time.

    Workers outlive stages, so what another operator has left is dropped first.
    """
    if key not in _held:
        _held.clear()
        release()
        _held[key] = make()
    return _held[key]


_models: dict[tuple[str, str], dict[str, np.ndarray]] = {}


def _save(path: str, arrays: dict[str, np.ndarray]) -> None:
    """Write an artefact beside its place and move it there whole."""
    where, path = store.locate(path)
    raw = io.BytesIO()
    np.savez(raw, **arrays)
    where.create_dir(path.rpartition("/")[0], recursive=True)
    own = f"{path}.{uuid.uuid4().hex}"
    with where.open_output_stream(own, compression=None) as f:
        f.write(raw.getvalue())
    where.move(own, path)


def _save_in_task(make: Callable[[], dict[str, np.ndarray]], path: str) -> None:
    _held.clear()  # what another operator has left with the worker goes first
    _save(path, make())
    release()


def saved_arrays(spark: SparkSession, name: str, sample: Iterable, make: Callable[[], dict[str, np.ndarray]], apart: bool = False) -> dict[str, np.ndarray]:
    """What ``make`` gives for a training sample, kept as an artefact of the shared folder.

    The artefact's name is a digest of the sample, its parameters among it, and of the code of
    ``make``'s module, so another sample or training never meets it. It is moved into place
    whole; who finds none makes it, in the driver or, ``apart``, in a task, so that the driver
    has the sample and what comes of it, but never what training takes.
    """
    digest = hashlib.sha256()
    for x in (inspect.getsource(sys.modules[make.__module__]), *sample):
        raw = x if isinstance(x, bytes) else repr(x).encode("utf-8", "surrogatepass")
        digest.update(len(raw).to_bytes(8, "little") + raw)
    key = digest.hexdigest()
    if (name, key) not in _models:
        uri = f"{scratch_root(spark)}/auditloom-models/{name}-{key}.npz"
        where, path = store.locate(uri)
        arrays = None
        if where.get_file_info(path).type != fs.FileType.File:
            if apart:
                spark.sparkContext.parallelize([uri], 1).foreach(partial(_save_in_task, make))
            else:
                arrays = make()
                _save(uri, arrays)
            release()  # what training took would stay with the driver to the end
        if arrays is None:
            with where.open_input_file(path) as f, np.load(io.BytesIO(f.read())) as found:
                arrays = dict(found)
        _models.clear()  # one sample's model at a time
        _models[name, key] = arrays
    return _models[name, key]


def small_batches(spark: SparkSession) -> None:
    """Bound the batches in which texts go to Python workers and back.

    The default is 10,000 rows or 64 MB; that much outside the heap, twice a task, is more
    than whole texts need.
    """
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", 1024), ("spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20)):
        spark.conf.set(key, str(most))


def cut(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    This cuts lineage, survives lost executors, and lets the next join bring its own
    exchanges on both sides, which adaptive execution can split where a key is hot.
    """
    small_batches(df.sparkSession)
    out, path = written(df, name)
    out._al_scratch = path
    if _open.scopes:
        _open.scopes[-1].append(out)
    _open.since += 1
    if _open.since >= UNSETTLED:
        _settled(df.sparkSession)
    return out


#: So many tables are written before the driver collects, so what its heap grows to follows the tables at hand, not all of a job's.
UNSETTLED = 2


class _Open(threading.local):
    def __init__(self) -> None:
        self.scopes: list[list[DataFrame]] = []
        self.since = 0


_open = _Open()


@contextlib.contextmanager
def tidy():
    """A scope whose written tables go at its end, but for those that were passed to what it gives.

    What the kept ones hold must have been written, as nothing else can be read later.
    """
    _open.scopes.append([])
    kept: list[DataFrame] = []

    def keep(table: DataFrame) -> DataFrame:
        kept.append(table)
        return table

    try:
        yield keep
    finally:
        written = _open.scopes.pop()
    gone = [t for t in written if not any(t is k for k in kept)]
    forget(*gone)
    if _open.since:
        for spark in {t.sparkSession for t in gone}:
            _settled(spark)
    if _open.scopes:
        _open.scopes[-1] += kept


def _settled(spark: SparkSession) -> None:
    _open.since = 0
    settle(spark)


def settle(spark: SparkSession) -> None:
    """Have the driver drop finished plans and shuffles, and its heap shrink, which else grows to its limit over many small jobs."""
    gc.collect()  # a Python handle keeps its plan in the JVM
    spark.sparkContext._jvm.System.gc()


def forget(*tables: DataFrame) -> None:
    """Delete tables that ``cut`` or ``running_total`` has written and nothing will read again."""
    for table in tables:
        path = getattr(table, "_al_scratch", None)
        if isinstance(path, str):
            remove(table.sparkSession, path)


def running_total(df: DataFrame, order: Sequence[Column], value: Column, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all rows before this one in ``order``.

    Range-partitions the rows, totals each partition, and shifts every partition's own
    running sum by the totals before it. The driver sees one number per partition.
    ``order`` should be nearly unique; equal rows are told apart arbitrarily.
    """
    spark = df.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = cut(
        df.withColumn("_al_v", value.cast("long"))
        .repartitionByRange(n, *order)
        .withColumn("_al_p", F.spark_partition_id()),
        "ranged",
    )
    totals = sorted(ranged.groupBy("_al_p").agg(F.sum("_al_v").alias("s")).collect())
    offsets, before = [], 0
    for part, total in totals:
        offsets.append((part, before))
        before += total or 0
    # One row per shuffle partition: the broadcast is bounded by that setting.
    shift = F.broadcast(spark.createDataFrame(offsets, "_al_p int, _al_o long"))
    own = F.sum("_al_v").over(Window.partitionBy("_al_p").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    summed = (
        ranged.withColumn("_al_s", own)
        .join(shift, "_al_p")
        .withColumn(out, F.coalesce(F.col("_al_s"), F.lit(0)) + F.col("_al_o"))
        .drop("_al_v", "_al_p", "_al_s", "_al_o")
    )
    summed._al_scratch = ranged._al_scratch
    return summed


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(u, v)``: rows ``(node, root)``, root the smallest node.

    Alternating large-star and small-star rounds, each a pre-aggregated minimum and an
    equi-join over written tables, until the edges are stars. Nothing but one row count
    and one checksum per round reaches the driver.
    """
    big, low = F.greatest("u", "v"), F.least("u", "v")
    stars = cut(edges.where(F.col("u") != F.col("v")).select(big.alias("u"), low.alias("v")).distinct(), "edges")
    seen = None
    for _ in range(max_rounds):
        both = stars.union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Large star: a node that has a smaller neighbour hands its larger ones to the smallest.
        least = cut(stars.groupBy("u").agg(F.min("v").alias("m")), "least")
        up = both.where(F.col("v") > F.col("u")).join(least, "u", "left").select(F.col("v").alias("u"), F.coalesce("m", "u").alias("v"))
        # A node's edges to smaller nodes keep only what the large side of them emits; its own minimum stays.
        large = cut(up.union(least.select("u", F.col("m").alias("v"))).where(F.col("u") != F.col("v")).distinct(), "large")
        forget(least, stars)
        # Small star: a node links all its smaller neighbours and itself to the smallest.
        least = cut(large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), "least")
        many = large.join(least.where("n > 1").select("u", "m"), "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = cut(many.union(least.select("u", F.col("m").alias("v"))).distinct(), "stars")
        forget(least, large)
        if _open.since:
            _settled(stars.sparkSession)
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == seen:
            break
        seen = tuple(now)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
