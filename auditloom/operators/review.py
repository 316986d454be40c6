"""Review provenance: required reviewers, hash binding, completeness, verdict lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditloom.functions.text import few

# The labels and the verdicts of a line that blocks.
BLOCKING = r"([Oo]verall[ \t]+[Vv]erdict|^VERDICT)[ \t]*:[ \t]*(CRITICAL|HALT|FAIL|MAJOR[ \t]+ISSUES|FIXES[ \t]+NEEDED|DO[ \t]+NOT[ \t]+TRUST)"


def required_coverage(required: DataFrame, dispatched: DataFrame, excused: DataFrame, key: str) -> DataFrame:
    """Each required reviewer as dispatched, excused or missing."""
    d = dispatched.select(key).distinct().withColumn("_d", F.lit(True))
    x = excused.select(key).distinct().withColumn("_x", F.lit(True))
    state = F.when(F.col("_d"), "dispatched").when(F.col("_x"), "excused").otherwise("missing")
    return required.join(d, key, "left").join(x, key, "left").withColumn("state", state).drop("_d", "_x")


def consolidated(rows: DataFrame, group: str, key: str) -> DataFrame:
    """Groups in which several rows share an id: one batch passed off as several reviews."""
    n, ids = F.count("*"), F.count_distinct(key)
    return rows.groupBy(group).agg(n.alias("n_rows"), ids.alias("n_ids"), ((n > ids) & (ids >= 1)).alias("consolidated"))


def newest(reports: DataFrame, key: str = "report_id") -> DataFrame:
    """The highest iteration of each report."""
    return reports.groupBy(key).agg(F.max_by(F.struct(*[c for c in reports.columns if c != key]), "iteration").alias("r")).select(key, "r.*")


def hash_binding(reviewed: DataFrame, disk: DataFrame) -> DataFrame:
    """Reviewed scripts against what is there: bound, mismatch or missing."""
    on = disk.select("path", F.col("sha256").alias("_now"))
    state = F.when(F.col("_now").isNull(), "missing").when(F.col("_now") != F.col("sha256"), "mismatch").otherwise("bound")
    return reviewed.join(on, "path", "left").withColumn("state", state).drop("_now")


def unreviewed(disk: DataFrame, reviewed: DataFrame, out_of_scope: DataFrame) -> DataFrame:
    return disk.join(reviewed.select("path").union(out_of_scope.select("path")), "path", "left_anti")


def blocking_line(line: Column) -> Column:
    return F.coalesce(line.rlike(BLOCKING), F.lit(False))


def broken_chain(manifests: DataFrame) -> DataFrame:
    """Reviews that supersede one that doesn't exist."""
    ids = manifests.select(F.col("review_id").alias("supersedes_review_id"))
    return manifests.where("supersedes_review_id IS NOT NULL").join(ids, "supersedes_review_id", "left_anti")


def token_coverage(reports: DataFrame, required: DataFrame, text: str = "text") -> DataFrame:
    """Without a manifest: lines that mention each required name, less those that excuse it.

    The required names are a declared handful; ``few`` checks that, as each line meets them all.
    """
    lines = reports.select(F.explode(F.split(text, "\n")).alias("line"))
    hits = lines.join(few(required), F.expr("contains(line, name)"))
    excuse = F.expr(r"line rlike concat('\\[EXCUSED:[^]]*\\][ \\t]+', name, '|', name, '[ \\t]+\\[EXCUSED:')")
    counts = hits.groupBy("name").agg(F.count("*").alias("total"), F.count_if(excuse).alias("excused"))
    out = required.join(counts, "name", "left").fillna(0, ["total", "excused"])
    return out.withColumn("state", F.when(F.col("total") > F.col("excused"), "dispatched").when(F.col("excused") > 0, "excused").otherwise("missing"))


def paired(manifests: DataFrame, reports: DataFrame) -> DataFrame:
    """Manifests with whether their report exists and names the review."""
    texts = reports.select(F.col("path").alias("report"), F.col("text").alias("_text"))
    named = F.expr("contains(_text, review_id)")
    state = F.when(F.col("_text").isNull(), "no report").when(named, "paired").otherwise("report lacks id")
    return manifests.join(texts, "report", "left").withColumn("state", state).drop("_text")


def blocking_left(manifests: DataFrame) -> DataFrame:
    """The newest manifest of each report still has blocking findings, or has been escalated."""
    return manifests.withColumn("blocked", (F.coalesce("remaining_blocking_count", F.lit(0)) > 0) | F.coalesce("escalated", F.lit(False)))


def explicit_phase(manifest_there: Column, phase: Column, verdict: Column) -> Column:
    """A phase asked for by name without provenance is at most YELLOW."""
    return F.when(~manifest_there & phase.isNotNull() & (verdict == "GREEN"), "YELLOW").otherwise(verdict)


def delegated(verdict: Column) -> Column:
    """Coverage that another gate relies on: its YELLOW is RED here."""
    return F.when(verdict == "YELLOW", "RED").otherwise(verdict)
