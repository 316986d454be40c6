"""Spelling variants by wildcard groups: words one insertion, deletion or replacement apart, no pairs made.

A word stands in one group for each of its positions: what is left when that position is
taken out, with the position. Words of a group differ by a replacement there, so a group's
size and its first two words by rank say how many a word meets and which is best. Words that
are what is left of others join the same partition: they are one deletion shorter. Ranks
number words by falling count, then by code points, so "the best near word" is the least
rank, and rows hold a rank in place of a word. A group's size is bounded by the alphabet, so
no key is hot; words are counted per task before they move.

What is left of a word of more than ``LONG`` code points goes by a digest of it, made from
prefix digests, so a word of a million letters makes a million short rows, not long ones.

Defined results: a null text has no words; a null id counts as an empty one in the hash that
chooses what is damaged; a run of any length is taken whole; repeated rows count each time;
words of equal count are told apart by code points; string ids are taken as they are; other
columns are left out; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from auditloom.llm.common import cut, forget, running_total

#: Code points of a run that counts as a word.
SHORTEST = 7
#: A form has at least so many times the occurrences of its variant.
RATIO = 10
#: What is left of longer words goes by digest.
LONG = 64
#: One in so many runs loses a letter where texts are damaged on purpose.
DAMAGED = 31

#: A prime and a base for digests of what is left: 127 bits, so that two of them hardly ever agree by chance.
_PRIME, _BASE = (1 << 127) - 1, int.from_bytes(hashlib.sha256(b"left of a word").digest()[:15], "big")


def lower_ascii(x: Column) -> Column:
    """``x`` with A to Z in lower case and all else as it is; for runs of Latin-1 letters."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(x.rlike("[À-Þ]"), F.translate(x, capitals, capitals.lower())).otherwise(F.lower(x))


def runs_of_letters(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shortest: int = SHORTEST) -> DataFrame:
    """``id, run``: lower-cased maximal runs of Latin-1 letters of ``shortest`` code points or more."""
    found = F.regexp_extract_all(F.col(text), F.lit(f"[A-Za-zÀ-ÿ]{{{shortest},}}"), F.lit(0))
    rows = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.explode(found).alias("run"))
    return rows.withColumn("run", lower_ascii(F.col("run")))


def damaged(runs: DataFrame, one_in: int = DAMAGED) -> DataFrame:
    """``word``: runs, of which the hash of id and run chooses one in so many to lose the letter it points at."""
    h = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
    at = (h % F.length("run")).cast("int")
    less = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    return runs.select(F.when(h % one_in == 0, less).otherwise(F.col("run")).alias("word"))


def ranked_words(words: DataFrame, least: int = 2, shortest: int = SHORTEST) -> DataFrame:
    """``word, n, rank``: distinct words of ``shortest`` code points and ``least`` occurrences or more, the most frequent first."""
    counted = words.where(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return running_total(counted, [F.desc("n"), F.col("word")], F.lit(1), "rank")


def _long_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of words of more than ``LONG`` code points, by digest, and the words themselves."""
    names = ["left", "at", "rank"]
    for batch in batches:
        for rank, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            n = len(word)
            after, power, whole = [0] * (n + 1), 1, 0
            for i in range(n - 1, -1, -1):
                after[i] = (after[i + 1] + ord(word[i]) * power) % _PRIME
                power = power * _BASE % _PRIME
            powers = [1]
            for _ in range(n):
                powers.append(powers[-1] * _BASE % _PRIME)
            lefts, ats = [f"{n}:{after[0]:x}"], [-1]
            for i, c in enumerate(word):
                # Equal neighbours leave the same: a negative place below -1 marks all but the first.
                if n - 1 > LONG:
                    lefts.append(f"{n - 1}:{(whole * powers[n - 1 - i] + after[i + 1]) % _PRIME:x}")
                else:
                    lefts.append(word[:i] + word[i + 1 :])
                ats.append(i if not i or word[i - 1] != c else -2 - i)
                whole = (whole * _BASE + ord(c)) % _PRIME
                if len(lefts) >= 1 << 16:
                    yield pa.RecordBatch.from_arrays([pa.array(lefts), pa.array(ats, pa.int32()), pa.array([rank] * len(ats), pa.int64())], names=names)
                    lefts, ats = [], []
            yield pa.RecordBatch.from_arrays([pa.array(lefts), pa.array(ats, pa.int32()), pa.array([rank] * len(ats), pa.int64())], names=names)


def left_of_words(words: DataFrame) -> DataFrame:
    """``left, at, rank``: every word without each of its letters, ``at`` its place from 0, and whole, at -1.

    A place whose letter equals the one before it leaves the same as that one; it is
    ``-2 - place``, so that a shorter word is met once.
    """
    own, n = F.col("word"), F.length("word")
    letter = lambda i: F.substring(own, i + 1, F.lit(1))

    def left(i: Column) -> Column:
        same = (i > 0) & (letter(i) == letter(i - 1))
        return F.struct(F.concat(F.substring(own, F.lit(1), i), F.substring(own, i + 2, n)).alias("left"), F.when(same, -2 - i).otherwise(i).alias("at"))

    short = words.where(n <= LONG)
    rows = F.concat(F.array(F.struct(own.alias("left"), F.lit(-1).alias("at"))), F.transform(F.sequence(F.lit(0), n - 1), left))
    made = short.select("rank", F.explode(rows).alias("r")).select("r.left", "r.at", "rank")
    return made.union(words.where(n > LONG).select("rank", "word").mapInArrow(_long_rows, "left string, at int, rank long"))


def near_words(words: DataFrame) -> DataFrame:
    """``rank, n_near, best``: of words with near ones, how many, and the least rank among them.

    One exchange by what is left: the groups' sizes and first two ranks are window values of
    its rows, and so is the shorter word where there is one.
    """
    rows = left_of_words(words).repartition("left")
    place = F.when(F.col("at") < -1, -2 - F.col("at")).otherwise(F.col("at"))
    rows = rows.withColumn("place", place)
    group = Window.partitionBy("left", "place").orderBy("rank")
    all_of = Window.partitionBy("left", "place").orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    shared = Window.partitionBy("left")
    once = F.col("at") >= 0
    rows = (
        rows.withColumn("_size", F.count("*").over(all_of)).withColumn("_first", F.first("rank").over(all_of)).withColumn("_next", F.lead("rank").over(group))
        .withColumn("_short", F.max(F.when(F.col("at") == -1, F.col("rank"))).over(shared))
        .withColumn("_longer", F.count_if(once).over(shared)).withColumn("_best", F.min(F.when(once, F.col("rank"))).over(shared))
    )
    whole = F.col("at") == -1
    other = F.when(F.col("_first") == F.col("rank"), F.col("_next")).otherwise(F.col("_first"))
    met = F.when(whole, F.col("_longer")).otherwise(F.col("_size") - 1 + F.when(once & F.col("_short").isNotNull(), 1).otherwise(0))
    best = F.when(whole, F.col("_best")).otherwise(F.least(other, F.when(once, F.col("_short"))))
    found = rows.select("rank", met.alias("_met"), best.alias("_least")).where("_met > 0")
    return found.groupBy("rank").agg(F.sum("_met").alias("n_near"), F.min("_least").alias("best"))


def roots(links: DataFrame) -> DataFrame:
    """``rank, root`` of ``links(rank, form)``, every link followed to its end by doubling over written tables.

    A form is ``RATIO`` times as frequent as its variant, so a chain is as long as its counts
    have digits, and few rounds settle it.
    """
    now = cut(links.select("rank", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("rank").alias("root"), F.col("root").alias("_ahead"))
        step = cut(now.join(ahead, "root", "left").select("rank", F.coalesce("_ahead", "root").alias("root"), F.col("_ahead").isNotNull().alias("_moved")), "roots")
        moved = step.where("_moved").limit(1).count()
        forget(now)
        now = step.select("rank", "root")
        now._al_scratch = step._al_scratch
        if not moved:
            return now


def spelling_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of ranked words ``(word, n, rank)``.

    A word's form is its best near word, where that is ``ratio`` times as frequent at least.
    """
    near = near_words(words)
    known = words.select(F.col("rank").alias("best"), F.col("n").alias("form_n"))
    joined = cut(words.join(near, "rank", "left").join(known, "best", "left").select("rank", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(F.col("form_n") >= ratio * F.col("n"), F.col("best")).alias("form"), "form_n"), "near")
    links = joined.where("form IS NOT NULL").select("rank", "form")
    ends = roots(links)
    name = lambda k, out: words.select(F.col("rank").alias(k), F.col("word").alias(out))
    out = joined.join(ends, "rank", "left").withColumnRenamed("form", "_form")
    out = out.join(name("_form", "form"), "_form", "left").join(name("root", "_end"), "root", "left")
    return out.select("word", "form", F.coalesce("_end", "word").alias("root"), "n", "n_near", F.when(F.col("_form").isNotNull(), F.col("form_n")).alias("form_n"))


def variants_of_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", one_in: int = DAMAGED) -> DataFrame:
    """Spelling variants among the words of all texts, one in ``one_in`` runs damaged first."""
    ranged = ranked_words(damaged(runs_of_letters(docs, doc_id, text), one_in))
    words = cut(ranged, "words")
    forget(ranged)
    return spelling_variants(words)
