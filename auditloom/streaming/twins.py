"""Streaming twins of batch operators, run to the end of what is there.

Each runs with ``availableNow``; the same transformations serve an endless stream. State is
kept by key in Spark's own state store, and what a batch changes is written under the
batch's number, so a batch that is repeated overwrites itself. A run that is given a folder
goes on where the last one in that folder stopped; without one it has a folder of its own
under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from auditloom.sources.scratch import children, exists, remove, scratch_path


def events(spark: SparkSession, sf_dir: str, pattern: str = "events.parquet*") -> DataFrame:
    """The events table as a stream; its time becomes a timestamp, which a watermark needs."""
    schema = spark.read.parquet(f"{sf_dir}/{pattern}").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/{pattern}")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


#: Batches that may stand beside the last compaction.
LOOSE = 16


def upserted(changes: DataFrame, keys: list[str], folder: str) -> DataFrame:
    """The latest row of each key of an aggregation that reports its changes.

    Only changed keys are written, a folder a batch; a reader takes the highest batch of a
    key. When a run ends with more than ``LOOSE`` batches, all that is there is written as one
    base, which counts once it is whole, and the batches it holds go: what is read grows with
    the keys, not with the batches that ever ran.
    """
    spark, out, bases = changes.sparkSession, f"{folder}/out", f"{folder}/base"

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    changes.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    schema = StructType([*changes.schema.fields]).add("batch", "long")
    rest = [c for c in changes.columns if c not in keys]
    number = lambda name: int(name.split("=")[1])
    whole = [number(n) for n in children(spark, bases) if exists(spark, f"{bases}/{n}/_SUCCESS")]
    upto = max(whole, default=-1)
    loose = [n for n in map(number, children(spark, out)) if n > upto]
    parts = [spark.read.schema(schema).option("basePath", out).parquet(*[f"{out}/batch={n}" for n in loose])] if loose else []
    if upto >= 0:
        parts.append(spark.read.schema(changes.schema).parquet(f"{bases}/upto={upto}").withColumn("batch", F.lit(-1).cast("long")))
    if not parts:
        return spark.createDataFrame([], changes.schema)
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    latest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("r")).select(*keys, "r.*")
    if len(loose) <= LOOSE:
        return latest
    base = max(loose)
    latest.write.mode("overwrite").parquet(f"{bases}/upto={base}")
    # What the new base holds goes; a frame that an earlier call gave can't be read any more then.
    for n in loose:
        remove(spark, f"{out}/batch={n}")
    for n in whole:
        remove(spark, f"{bases}/upto={n}")
    return spark.read.schema(changes.schema).parquet(f"{bases}/upto={base}")


def daily_counts(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    """Events a day and type."""
    stream = events(spark, sf_dir).withWatermark("ts", "1 day")
    spec = stream.groupBy(F.window("ts", "1 day"), "event_type").agg(F.count("*").alias("n"))
    changes = spec.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "event_type", "n")
    return upserted(changes, ["day", "event_type"], folder or scratch_path(spark, "daily"))


def captured(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    """First capture of each event within the watermark; the source is fed twice over."""
    stream = events(spark, sf_dir)
    both = stream.union(events(spark, sf_dir)).withWatermark("ts", "60 days")
    work = folder or scratch_path(spark, "captured")
    first = both.dropDuplicatesWithinWatermark(["event_id"]).select("event_id", "event_type")
    first.writeStream.outputMode("append").format("parquet").option("path", f"{work}/out").option("checkpointLocation", f"{work}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(first.schema).parquet(f"{work}/out")


def last_wins(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    """Each user's last event, by time and then by id."""
    last = F.max_by(F.struct("event_id", "event_type"), F.struct("ts", "event_id")).alias("l")
    changes = events(spark, sf_dir).groupBy("user_id").agg(last).select("user_id", "l.event_id", "l.event_type")
    return upserted(changes, ["user_id"], folder or scratch_path(spark, "last"))
