"""Line deduplication by a suffix array over line ids.

Documents are sequences of line ids (128-bit hashes of their trimmed lines, blank lines
left out), cut at document ends. Prefix doubling ranks the suffixes by their first 1, 2,
4, ... lines; suffixes whose prefix occurs once are final and drop out, so each round
holds repeated runs alone. Equal ranks are the intervals of the suffix array whose longest
common prefix is at least that length. Every line is one word or more, so a run of
``min_words`` words has at most ``min_words`` lines and the rounds are few whatever the
corpus holds.

The suffix array is thus kept as ranks: suffixes of equal rank at level k are one interval
whose longest common prefix is 2^k lines or more, and an interval of length m is where the
ranks at a, and at a + m - 2^k, agree for the largest 2^k up to m. Longer intervals needn't
be ranked: a maximal repeated run of ``min_words`` words or more is covered by the
shortest runs of that many words inside it, each of at most ``min_words`` lines, and what
is deleted, the union of later copies, is the same.

A run is a copy to be deleted where it has ``min_words`` words or more and occurs before,
in order of document id and line. Each maximal repeated run is the union of the shortest
such runs that start or end at its lines; two overlapping prefixes of known rank decide
whether two of those are equal. The first occurrence stays whole, also where a run
overlaps itself.

Defined results: null and empty texts stay as they are; blank lines stay; rows of equal id
and text are one document and get the same result; rows of one id and several texts are
several documents, in the order of a hash of the text; null ids come after the others; a
text of any length is taken whole; extra columns are carried along, but for one named as
``out``, which is replaced; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType
from pyspark.sql.window import Window

from auditloom.llm.common import WORD, cut, forget, running_total, small_batches, tidy

BLANKS = " \t\r\x0b\x0c"
#: A document; a null id is ``late`` with zero in its place, as joins by name don't match nulls.
DOC = ["late", "doc_id", "dk"]


def _lines(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``late, doc_id, dk, i, h1, h2, w``: the lines that aren't blank, by place."""
    trimmed = F.transform(F.split(F.col("text"), "\n"), lambda x: F.btrim(x, F.lit(BLANKS)))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where("text IS NOT NULL")
    rows = rows.select(F.col("doc_id").isNull().alias("late"), F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.xxhash64("doc_id", "text").alias("dk"), F.posexplode(F.filter(trimmed, lambda x: x != "")).alias("i", "line"))
    words = F.greatest(F.lit(1), F.regexp_count("line", F.lit(WORD)))
    # Equal rows would repeat their places; one of them stands for all.
    return rows.select(*DOC, "i", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"), words.alias("w")).dropDuplicates([*DOC, "i"])


def _ranked(rows: DataFrame, key: list[str], name: str) -> DataFrame:
    """Rows of keys that occur more than once, with ``rank``: how many rows have smaller keys."""
    with tidy() as keep:
        groups = cut(rows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1"), f"{name}-groups")
        ranks = running_total(groups, [F.col(k) for k in key], F.col("n"), "rank")
        # Both sides are written tables, so a very common line's rows can be split among tasks.
        return keep(cut(rows.join(cut(ranks.select(*key, "rank"), f"{name}-ranks"), key).drop(*key), name))


def suffix_ranks(lines: DataFrame, longest: int) -> DataFrame:
    """``late, doc_id, dk, i, k, rank, w``: ranks of runs of 2^k lines that occur more than once."""
    level = _ranked(lines, ["h1", "h2"], "level0")
    levels, k = [level.withColumn("k", F.lit(0))], 0
    while 2 << k <= longest:
        after = level.select(*DOC, (F.col("i") - (1 << k)).alias("i"), F.col("rank").alias("r2"))
        pairs = cut(level.withColumnRenamed("rank", "r1").join(after, [*DOC, "i"]), "pairs")
        level, k = _ranked(pairs, ["r1", "r2"], f"level{k + 1}"), k + 1
        forget(pairs)
        levels.append(level.withColumn("k", F.lit(k)))
    out = levels[0]
    for other in levels[1:]:
        out = out.unionByName(other)
    return out


def repeated_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = 50) -> DataFrame:
    """``doc_id, dk, a, b``: lines a to b (exclusive) of a document that occur before."""
    ranks = suffix_ranks(cut(_lines(docs, doc_id, text), "lines"), min_words)
    # The shortest qualifying runs from and up to every line, within unbroken runs of repeated lines.
    single = ranks.where("k = 0").select(*DOC, "i", "w")
    single = single.withColumn("seg", F.col("i") - F.row_number().over(Window.partitionBy(*DOC).orderBy("i")))
    w = Window.partitionBy(*DOC, "seg").orderBy("i")

    def reach(frame) -> F.Column:
        start = F.struct(F.lit(0).alias("s"), F.lit(0).alias("m"))
        step = lambda acc, x: F.when(acc["s"] >= min_words, acc).otherwise(F.struct((acc["s"] + x).alias("s"), (acc["m"] + 1).alias("m")))
        return F.aggregate(frame, start, step, lambda acc: F.when(acc["s"] >= min_words, acc["m"]))

    ahead = reach(F.collect_list("w").over(w.rowsBetween(0, min_words - 1)))
    behind = reach(F.reverse(F.collect_list("w").over(w.rowsBetween(-(min_words - 1), 0))))
    found = single.select(*DOC, "i", ahead.alias("f"), behind.alias("g"))
    ends = F.array(F.struct(F.col("i").alias("a"), F.col("f").alias("m")), F.struct((F.col("i") - F.col("g") + 1).alias("a"), F.col("g").alias("m")))
    runs = found.select(*DOC, F.explode(ends).alias("r")).select(*DOC, "r.a", "r.m").where("m IS NOT NULL").distinct()
    k = F.floor(F.log2(F.col("m").cast("double"))).cast("int")
    runs = runs.withColumn("k", k).withColumn("z", F.expr("a + m - cast(power(2, k) as int)"))
    heads = ranks.select(*DOC, F.col("i").alias("a"), "k", F.col("rank").alias("r1"))
    tails = ranks.select(*DOC, F.col("i").alias("z"), "k", F.col("rank").alias("r2"))
    classed = cut(runs.join(heads, [*DOC, "a", "k"]).join(tails, [*DOC, "z", "k"]).select(*DOC, "a", "m", "r1", "r2"), "classed")
    order = F.struct(*DOC, "a")
    first = classed.groupBy("m", "r1", "r2").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    copies = classed.join(cut(first, "first"), ["m", "r1", "r2"]).where(order > F.col("first"))
    same = (F.col("late") == F.col("first.late")) & (F.col("doc_id") == F.col("first.doc_id")) & (F.col("dk") == F.col("first.dk"))
    begin = F.when(same, F.greatest("a", F.col("first.a") + F.col("m"))).otherwise(F.col("a"))
    return copies.select(F.when(~F.col("late"), F.col("doc_id")).alias("doc_id"), "dk", begin.alias("a"), (F.col("a") + F.col("m")).alias("b")).where("a < b")


def without_lines(text: str, runs: list[tuple[int, int]]) -> tuple[str, int]:
    """``text`` without the lines (blank ones not counted) of ``runs``, and how many went."""
    drop = bytearray()
    for a, b in runs:
        if len(drop) < b:
            drop += bytes(b - len(drop))
        drop[a:b] = b"\1" * (b - a)
    kept, i = [], 0
    for line in text.split("\n"):
        if line.strip(BLANKS):
            if i >= len(drop) or not drop[i]:
                kept.append(line)
            i += 1
        else:
            kept.append(line)
    return "\n".join(kept), sum(drop)


def deduplicate_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = 50, out: str = "n_deleted") -> DataFrame:
    """``docs`` with repeated runs of lines deleted, and ``out``, how many lines went; it replaces a column of its name."""
    small_batches(docs.sparkSession)
    docs = docs.drop(out)
    with tidy() as keep:
        runs = repeated_runs(docs, doc_id, text, min_words)
        gone = keep(cut(runs.groupBy("doc_id", "dk").agg(F.collect_set(F.struct("a", "b")).alias("_al_runs")), "gone"))
    gone = gone.select(F.col("doc_id").alias("_al_id"), F.col("dk").alias("_al_dk"), "_al_runs")
    keyed = docs.withColumns({"_al_k": F.xxhash64(F.col(doc_id).cast("long"), F.col(text)), "_al_i": F.col(doc_id).cast("long")})
    # One plan at every size: the texts meet their runs by a sort-merge join on a nearly unique key.
    rows = keyed.join(gone.hint("merge"), F.col("_al_i").eqNullSafe(F.col("_al_id")) & (F.col("_al_k") == F.col("_al_dk")), "left").drop("_al_i", "_al_k", "_al_id", "_al_dk")
    at = docs.columns.index(text)
    schema = StructType([*docs.schema.fields]).add(out, LongType())
    schema.fields[at].dataType = StringType()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(k, 1024) for whole in batches for k in range(0, whole.num_rows, 1024)):
            texts, n = batch.column(at), []
            runs = batch.column(batch.num_columns - 1)
            if runs.null_count < len(runs):
                rest = []
                for t, r in zip(texts.to_pylist(), runs.to_pylist(), strict=True):
                    t, gone = without_lines(t, [(x["a"], x["b"]) for x in r]) if r else (t, 0)
                    rest.append(t)
                    n.append(gone)
                texts = pa.array(rest, texts.type)
            else:
                n = [0] * len(runs)
            columns = [texts if i == at else c for i, c in enumerate(batch.columns[:-1])]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n, pa.int64())], names=[*batch.schema.names[:-1], out])

    return rows.mapInArrow(run, schema)
