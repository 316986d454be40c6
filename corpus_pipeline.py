"""The corpus pipeline: documents to a mixed, deduplicated and encoded training set.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept, and
returns the columns of documents; the last one returns every row's ids and digests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditloom.llm import bpe, lines, mixing, simhash, toxicity
from auditloom.llm.catalog import vocabulary
from auditloom.llm.common import cut


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half.

    A null or empty text has the score of an empty window; without labelled rows of both
    classes nothing is rejected; repeated rows and rows of one id are scored one by one; very
    long texts are scored by all their windows; an empty table stays empty.
    """
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score_documents(docs, model, out="_al_score").where("_al_score < 0.5").drop("_al_score")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without line runs of 50 words or more that occur before; ``n_chars`` follows the text.

    Documents come in order of their ids, those without one last, those of one id by a hash
    of their texts; equal rows get equal results; null, empty and blank texts stay as they
    are; very long texts are taken whole; an empty table stays empty.
    """
    out = lines.deduplicate_lines(docs, out="_al_gone")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_al_gone") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*_columns(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates, that of the smallest id.

    Shingles are of five words; fingerprints link at three or fewer differing bits, and
    shingle sets at a Jaccard similarity of 0.8 or more. Null and blank texts are one group;
    texts of fewer words are one shingle; very long texts are compared by all their shingles;
    of rows of one id the one with the least text hash stays, and a row without an id only
    where its group has no id; an empty table stays empty.
    """
    return simhash.one_of_each(docs, shingle=5, radius=3).select(*_columns(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in the weights 3, 1, 2 at 150 % of all words, each document twice at most.

    A document read twice is two rows, one read in part a row with its first words; null is a
    source of its own, last in order; a null or blank text has no words and is a row for every
    whole reading of its source; rows of one id are taken by size and row hash; an empty table
    stays empty.
    """
    out = mixing.mixed_documents(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row's ids with their digests and that of the decoded text.

    A null text is empty and has no ids; rows are encoded one by one, whole; an empty table
    gives an empty result.
    """
    return bpe.digest_documents(docs, vocabulary("word_bpe_49k.json"), with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("SimHash near-dedup", drop_near_duplicates),
    ("mixing sources to target weights", mix),
    ("BPE encoding and decoding", encode),
]

#: A trained network, XXH64 fingerprints and byte-pair merges are beyond SQL; a test holds the whole chain against a
#: plain version of every stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs, name.split()[0])
    return docs
