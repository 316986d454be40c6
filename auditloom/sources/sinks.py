"""Writers: append-only JSON lines, key files, sidecars, settings, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def append_ndjson(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("ignoreNullFields", "false").json(path)


def write_key(df: DataFrame, path: str) -> None:
    df.select("original", "pseudonym", "type", "confidence", "notes").write.mode("overwrite").csv(path, header=True)


def write_report(df: DataFrame, path: str, order: str = "line_no", text: str = "markdown") -> None:
    """A report's lines, in order, as text files."""
    df.orderBy(order).select(F.col(text).alias("value")).write.mode("overwrite").text(path)


def sidecar_json(status: DataFrame) -> DataFrame:
    """``value``: one JSON object of every path and its status (``path, status``), in order of path.

    A sidecar is one file of a project, so its paths are that project's.
    """
    entries = F.map_from_entries(F.sort_array(F.collect_list(F.struct("path", "status"))))
    return status.dropDuplicates(["path"]).agg(F.to_json(entries).alias("value"))


def write_json(df: DataFrame, path: str) -> None:
    """Documents in ``value``, as text."""
    df.select("value").coalesce(1).write.mode("overwrite").text(path)


def deny_toml(paths: DataFrame, section: str = "permissions") -> DataFrame:
    """``line_no, markdown``: a section of settings that denies every path, in order."""
    quoted = F.concat(F.lit('"'), F.replace(F.replace("path", F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('" = "none"'))
    listed = paths.distinct().agg(F.sort_array(F.collect_list(quoted)).alias("l"))
    return listed.select(F.posexplode(F.concat(F.array(F.lit(f"[{section}]")), "l")).alias("line_no", "markdown"))
