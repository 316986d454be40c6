"""Tables that a job writes for itself, in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share, as ``spark.checkpoint.dir`` names it.

    Only a purely local session (tests) without that setting gets a temporary folder, which
    goes when the process ends; on a cluster the setting is required, as no other folder is
    known to be shared.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base:
        return base.rstrip("/")
    if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        folder = tempfile.mkdtemp(prefix="auditloom-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _local_roots[app] = "file://" + folder
    return _local_roots[app]


def _hadoop(spark: SparkSession, path: str):
    """A path and its file system."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; what is still there goes when the driver's JVM ends."""
    path = f"{scratch_root(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    where, files = _hadoop(spark, path)
    files.deleteOnExit(where)
    return path


def exists(spark: SparkSession, path: str) -> bool:
    where, files = _hadoop(spark, path)
    return files.exists(where)


def children(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none where there is no such folder."""
    where, files = _hadoop(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(where)) if files.exists(where) else []


def remove(spark: SparkSession, path: str) -> None:
    where, files = _hadoop(spark, path)
    files.delete(where, True)


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written as Parquet to the shared folder and read back, and where; this cuts lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path
