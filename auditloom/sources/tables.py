"""Readers of the driver's tables and of the text formats that ledgers come in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType
from pyspark.sql.window import Window


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A Parquet table; timestamps without zone become timestamps, as streams need them."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    zoneless = [f.name for f in df.schema.fields if isinstance(f.dataType, TimestampNTZType)]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in zoneless})


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt over all cores where its files give fewer tasks than there are; tables of many files stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, line_no, value`` of text files, lines numbered from 0 in each file, blank ones counted.

    A file may be read in several parts: each part's lines are numbered where they are read,
    and shifted by the lines of the file's parts before it, one number a part.
    """
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("_m"))
    raw = raw.withColumns({"_p": F.shiftright("_m", 33), "_i": F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))})
    parts = raw.groupBy("file", "_p").agg(F.min("_i").alias("_first"), F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("file").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shift = parts.select("file", "_p", (before - F.col("_first")).alias("_shift"))
    return raw.join(shift, ["file", "_p"]).select("file", (F.col("_i") + F.col("_shift")).alias("line_no"), "value")


def ndjson(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Append-only JSON lines with ``file, line_no``; a malformed line fills ``_corrupt`` and fails nothing."""
    return parse_ndjson(text_lines(spark, path), schema)


def json_document(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Files that are one JSON document each: ``file`` and its fields; a malformed one fills ``_corrupt``."""
    rows = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.lit(0).alias("line_no"), "value")
    return parse_ndjson(rows, schema).drop("line_no")


def jdbc_query(spark: SparkSession, url: str, sql: str, split: tuple[str, int, int, int] | None = None, **options) -> DataFrame:
    """A query's result over JDBC; ``split`` (column, least, greatest, parts) reads it in several connections."""
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if split is None:
        return reader.option("query", sql).load()
    column, least, greatest, parts = split
    bounds = {"partitionColumn": column, "lowerBound": least, "upperBound": greatest, "numPartitions": parts}
    return reader.option("dbtable", f"({sql}) q").options(**bounds).load()


def sqlite_query(spark: SparkSession, path: str, sql: str, schema: str) -> DataFrame:
    """A query's result from an SQLite file that executors can open, read-only, in one task and by batches.

    The file is a library's own database, which its owner may hold open; columns follow ``schema``.
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    form = to_arrow_schema(spark.createDataFrame([], schema).schema)

    def run(batches):
        import sqlite3

        for _ in batches:
            with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
                cursor = db.execute(sql)
                while rows := cursor.fetchmany(4096):
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), form, strict=True)], schema=form)

    return spark.range(1, numPartitions=1).mapInArrow(run, schema)


def parse_ndjson(lines: DataFrame, schema: StructType) -> DataFrame:
    """``lines(value, line_no, ...)`` to records; blank lines are left out."""
    full = StructType([*schema.fields, StructField("_corrupt", StringType())])
    parsed = F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    rest = [c for c in lines.columns if c != "value"]
    return lines.where(F.trim("value") != "").select(*rest, parsed.alias("r")).select(*rest, "r.*")


def key_csv(spark: SparkSession, path: str) -> DataFrame:
    """A pseudonym key: original, pseudonym, type, confidence, notes."""
    return spark.read.csv(path, header=True, schema="original string, pseudonym string, type string, confidence double, notes string")


def file_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Files under ``root`` with size and time, content unread; system litter is left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", F.col("length").alias("bytes"), "modificationTime")
    return files.where(~F.col("path").rlike(r"/(\.git|__pycache__|\.svn)/|/(\.DS_Store|Thumbs\.db|desktop\.ini)$"))


def whole_texts(spark: SparkSession, root: str) -> DataFrame:
    """Each file as one row: path, text."""
    return spark.read.text(root, wholetext=True, recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
