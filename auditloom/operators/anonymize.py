"""Pseudonym keys, replacement, scrubbing and verification."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from auditloom.functions.rules import INSTITUTION, SCRUB

# Least score per entity that is replaced, and what replaces it: a numbered
# stand-in with this prefix, or a token. Other entities stay in the text.
ENTITY_FLOOR = {
    "PERSON": 0.6, "LOCATION": 0.5, "INSTITUTION": 0.5, "EMAIL_ADDRESS": 0.4, "PHONE_NUMBER": 0.4,
    "US_SSN": 0.4, "CREDIT_CARD": 0.4, "IP_ADDRESS": 0.4, "DATE_OF_BIRTH": 0.7, "HIPAA_IDENTIFIER": 0.6,
}
NUMBERED = {"PERSON": "P", "LOCATION": "LOC", "INSTITUTION": "ORG"}
TOKENS = {
    "EMAIL_ADDRESS": "[EMAIL REMOVED]", "PHONE_NUMBER": "[PHONE REMOVED]", "US_SSN": "[SSN REMOVED]", "CREDIT_CARD": "[CARD REMOVED]",
    "IP_ADDRESS": "[IP REMOVED]", "DATE_OF_BIRTH": "[DOB REMOVED]", "HIPAA_IDENTIFIER": "[HIPAA REMOVED]",
}


def _lookup(table: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[F.col("entity")]


def detections(found: DataFrame, keys: list[str], floor: float = 0.35) -> DataFrame:
    """What is replaced: the best find of a place, if above its entity's floor, replaceable and not blank.

    ``keys`` name a place, its text among them; an entity that has no replacement still
    takes its place from a find of lower score.
    """
    w = Window.partitionBy(*keys).orderBy(F.desc("score"), "entity")
    best = found.where(F.col("score") >= floor).withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
    return best.where((F.col("score") >= _lookup(ENTITY_FLOOR)) & (F.trim("value") != ""))


def value_summary(found: DataFrame, most: int = 20) -> DataFrame:
    """Per entity its first values in order, with the best score of each."""
    best = found.groupBy("entity", "value").agg(F.max("score").alias("score"), F.count("*").alias("n"))
    w = Window.partitionBy("entity").orderBy("value")
    return best.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= most)


def pseudonym_key(found: DataFrame, start: dict[str, int] | None = None) -> DataFrame:
    """``original, pseudonym, type``: numbered by first occurrence, best score first.

    ``found`` has entity, value, score, at; ties go by place. Only distinct values are ordered.
    Entities without a replacement get no row.
    """
    first = found.groupBy("entity", "value").agg(F.max("score").alias("score"), F.min("at").alias("at"))
    w = Window.partitionBy("entity").orderBy(F.desc("score"), "at", "value")
    prefix = _lookup(NUMBERED)
    offset = F.coalesce(F.create_map(*[F.lit(x) for kv in (start or {"-": 0}).items() for x in kv])[F.col("entity")], F.lit(0))
    n = F.row_number().over(w) + offset
    number = F.concat(prefix, F.when(n < 10, F.concat(F.lit("0"), n.cast("string"))).otherwise(n.cast("string")))
    # Only names, places and institutions are numbered; the rest needs no order.
    numbered = first.where(prefix.isNotNull()).withColumn("pseudonym", number)
    fixed = first.withColumn("pseudonym", _lookup(TOKENS)).where("pseudonym IS NOT NULL")
    return numbered.unionByName(fixed).select(F.col("value").alias("original"), "pseudonym", F.col("entity").alias("type"))


def merge_keys(auto: DataFrame, user: DataFrame) -> DataFrame:
    """User rows override; rows only the user has are appended with full confidence."""
    a, u = auto.alias("a"), user.alias("u")
    joined = a.join(u, F.lower("a.original") == F.lower("u.original"), "full_outer")
    return joined.select(
        F.coalesce("a.original", "u.original").alias("original"),
        F.coalesce("u.pseudonym", "a.pseudonym").alias("pseudonym"),
        F.coalesce("a.type", F.lit("user-defined")).alias("type"),
        F.when(F.col("a.original").isNull(), 1.0).otherwise(F.col("a.confidence")).alias("confidence"),
        F.when(F.col("u.original").isNotNull(), "user").otherwise("auto").alias("notes"),
    )


def next_ordinals(key: DataFrame) -> DataFrame:
    """Per numbered prefix the largest ordinal in use."""
    n = F.regexp_extract("pseudonym", r"^(P|LOC|ORG)([0-9]+)$", 2)
    return key.where(n != "").groupBy(F.regexp_extract("pseudonym", r"^(P|LOC|ORG)", 1).alias("prefix")).agg(F.max(n.cast("int")).alias("last"))


def replace_longest_first(text: Column, pairs: list[tuple[str, str]]) -> Column:
    """Literal, case-insensitive replacement, longer originals first."""
    for original, stand_in in sorted(pairs, key=lambda p: (-len(p[0]), p[0])):
        text = F.regexp_replace(text, "(?i)" + re.sub(r"([^A-Za-z0-9 ])", r"\\\1", original), stand_in.replace("\\", "\\\\").replace("$", "\\$"))
    return text


def scrub(text: Column) -> Column:
    """What a key missed: e-mails, then phone-like numbers, then social security numbers."""
    for pattern, token in SCRUB:
        text = F.regexp_replace(text, pattern, token)
    return text


def residual(found: DataFrame) -> DataFrame:
    """Finds that aren't tokens of the anonymisation itself."""
    return found.where(~F.col("value").rlike(r"^\[.*\]$") & ~F.col("value").rlike(r"^(P|LOC|ORG)[0-9]{2,}$"))


def institutions(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Institution names by either pattern."""
    found = F.concat(*[F.regexp_extract_all(text, F.lit(p), F.lit(0)) for p in INSTITUTION])
    return df.select(*keys, F.explode(found).alias("value"))
