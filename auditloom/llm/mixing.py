"""Mixing sources to target weights by capped water-filling.

Every source asks for its weight's share of the mix; a source may be read at most
``max_epochs`` times, and what it can't give is shared again by weight among the others
until no target is above its cap. A target is met by whole repetitions of every document
of the source and, for the rest, one more reading of documents in a seeded order, the last
of them in part, so a source's taken words equal its target rounded down.

Defined results: a null text has size 0; null is a source of its own, last in order; a
source without words has target 0; an empty table gives an empty mix; further columns are
carried along, but for those of a result's name, which it replaces. Rows of one id, or of
none, stand side by side in the seeded order, by size and then by a hash of the whole row,
so a rerun takes the same words; rows that agree in all of that are rows of their own, and
which of them is read in part is no difference in the result. Long texts are read whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from auditloom.llm.common import WORD, cut, running_total

#: A source's seeded order is dealt into so many buckets; only the bucket in which the
#: target falls is ordered row by row.
BUCKETS = 4096


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _key(source: str) -> list[Column]:
    return [F.col(source).isNull().alias("_al_null"), F.coalesce(F.col(source), F.lit("")).alias("_al_src")]


def source_targets(sized: DataFrame, source: str, size: str, weights: Sequence[int], share: float, max_epochs: float) -> DataFrame:
    """Per source: ``_al_null, _al_src, source_size, target`` by capped water-filling."""
    sizes = cut(sized.groupBy(*_key(source)).agg(F.sum(size).alias("source_size")), "sources")
    ranked = running_total(sizes, [F.col("_al_null"), F.col("_al_src")], F.lit(1), "_al_rank")
    at = (F.col("_al_rank") % len(weights)).cast("int")
    ranked = cut(
        ranked.withColumn("_al_w", F.get(F.array(*[F.lit(int(w)) for w in weights]), at)).withColumn("_al_cap", F.col("source_size") * F.lit(float(max_epochs))),
        "weighted",
    )
    total = (ranked.agg(F.sum("source_size")).first()[0] or 0) * share
    # A source is capped where its cap is below weight x level; the level only rises.
    level, before = 0.0, -1.0
    while level != before:
        before = level
        full = F.col("_al_cap") < F.col("_al_w") * F.lit(level)
        held, open_w = ranked.agg(F.sum(F.when(full, F.col("_al_cap")).otherwise(0.0)), F.sum(F.when(~full, F.col("_al_w")).otherwise(0))).first()
        if not open_w:
            level = float("inf")
            break
        level = max(level, (total - held) / open_w)
    target = F.col("_al_cap") if level == float("inf") else F.least(F.col("_al_cap"), F.col("_al_w") * F.lit(level))
    return ranked.select("_al_null", "_al_src", "source_size", target.alias("target"))


ADDED = ("source_size", "target", "repeats", "extra", "taken")


def _row_hash(docs: DataFrame) -> Column:
    """A hash of the columns that have one; maps have none."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()])


def mix_sources(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", size: str = "size", weights: Sequence[int] = (3, 1, 2), share: float = 1.5, max_epochs: float = 2.0, seed: int = 42) -> DataFrame:
    """``docs`` with ``source_size, target, repeats, extra, taken``; they replace columns of their names.

    ``repeats`` whole readings and the first ``extra`` words once more make ``taken``.
    ``docs`` must have the word count in ``size``.
    """
    if {doc_id, source, size} & set(ADDED):
        raise ValueError(f"the id, source and size may not be named as a result: {', '.join(ADDED)}")
    docs = docs.drop(*ADDED)
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary"))
    base = docs.withColumns({"_al_null": F.col(source).isNull(), "_al_src": F.coalesce(F.col(source), F.lit("")), "_al_h": order})
    base = base.withColumn("_al_b", F.conv(F.substring("_al_h", 1, 3), 16, 10).cast("int"))
    targets = source_targets(docs, source, size, weights, share, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    targets = cut(targets.withColumn("repeats", whole).withColumn("_al_rest", F.floor("target").cast("long") - F.col("repeats") * F.col("source_size")), "targets")
    # At most BUCKETS rows a source: where in the seeded order the rest of the target ends.
    sums = base.groupBy("_al_null", "_al_src", "_al_b").agg(F.sum(size).alias("_al_n"))
    before = F.coalesce(F.sum("_al_n").over(Window.partitionBy("_al_null", "_al_src").orderBy("_al_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    edge = (
        sums.withColumn("_al_before", before)
        .join(targets, ["_al_null", "_al_src"])
        .where((F.col("_al_before") < F.col("_al_rest")) & (F.col("_al_before") + F.col("_al_n") >= F.col("_al_rest")))
        .select("_al_null", "_al_src", F.col("_al_b").alias("_al_edge"), "_al_before")
    )
    plan = cut(targets.join(edge, ["_al_null", "_al_src"], "left"), "plan")
    rows = base.join(plan, ["_al_null", "_al_src"])
    at_edge = F.coalesce(F.col("_al_b") == F.col("_al_edge"), F.lit(False))
    sure = rows.where(~at_edge).withColumn("extra", F.when(F.col("_al_b") < F.col("_al_edge"), F.col(size)).otherwise(F.lit(0)).cast("long"))
    # An edge bucket may hold all rows of one id, so its order is made over ranges of rows, not in one task;
    # the rows are numbered as they are written, which tells equal ones apart.
    close = cut(rows.where(at_edge).withColumns({"_al_r": _row_hash(docs), "_al_u": F.monotonically_increasing_id()}), "close")
    keys = [F.col("_al_null"), F.col("_al_src"), F.col("_al_h"), F.col(doc_id).asc_nulls_last(), F.col(size), F.col("_al_r"), F.col("_al_u")]
    summed = running_total(close, keys, F.col(size), "_al_upto")
    starts = cut(summed.groupBy("_al_null", "_al_src").agg(F.min("_al_upto").alias("_al_start")), "starts")
    summed = summed.join(starts, ["_al_null", "_al_src"])
    left = F.col("_al_rest") - F.col("_al_before") - (F.col("_al_upto") - F.col("_al_start"))
    close = summed.withColumn("extra", F.greatest(F.lit(0), F.least(F.col(size), left)).cast("long"))
    out = sure.unionByName(close, allowMissingColumns=True).withColumn("taken", F.col("repeats") * F.col(size) + F.col("extra"))
    return out.drop(*[c for c in out.columns if c.startswith("_al_")])


def mixed_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", **parameters) -> DataFrame:
    """The mix itself: ``docs``' columns, a row per whole reading and one per partial reading.

    A partial reading holds the document's first ``extra`` words. Columns of any name are
    carried along.
    """
    columns = docs.columns
    plain = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(f"`{doc_id}`").alias("id"), F.col(f"`{source}`").alias("from")).withColumn("size", n_words(F.col(f"row.`{text}`")))
    mixed = mix_sources(plain, doc_id="id", source="from", size="size", **parameters)
    part = F.regexp_extract(F.col(f"row.`{text}`"), r"^[\x20\x09-\x0D]*", 0)
    words = F.array_join(F.slice(F.regexp_extract_all(F.col(f"row.`{text}`"), F.lit(f"({WORD}[\\x20\\x09-\\x0D]*)"), 1), F.lit(1), F.col("extra").cast("int")), "")
    cut_text = F.when(F.col("extra") >= F.col("size"), F.col(f"row.`{text}`")).otherwise(F.concat(part, words))
    whole = mixed.where("repeats > 0").withColumn("_al_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("repeats")))).select("row.*")
    partial = mixed.where("extra > 0").withColumn("_al_t", cut_text).select(*[F.col("_al_t").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in columns])
    return whole.unionByName(partial)
