"""From raw documents to packed training sequences.

Each stage works on all rows that its predecessor kept, and its result is written as
Parquet and read again as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import contamination, jaccard, naming, packing, toxicity
from tillroll.llm.stages import fresh, table, written


# Each stage takes any columns beside doc_id and text, under whatever names, and returns them.
# An empty table stays empty.


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold; the model learns from the labels' table. A null
    or empty text has no insult and stays. Equal rows share their fate."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    score = fresh(docs, "toxicity_of_text")
    return toxicity.toxicity(docs, model, score).where(F.col(score) < toxicity.THRESHOLD).drop(score)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, that with the largest doc_id. Null and empty
    texts are equal; a null doc_id is the smallest; of rows equal in both, one stays."""
    return naming.without_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near copies (five-word
    shingles, similarity 0.8 or more). Texts without words are in no group, and rows without
    a doc_id stay if one of them is in no group. Rows of one doc_id stay or go together."""
    groups = jaccard.near_duplicates(docs, words=5, percent=80)
    kept = fresh(docs, "kept_id")
    first = groups.where("component_id is null or doc_id = component_id").select(F.col("doc_id").alias(kept))
    return docs.join(first.distinct(), docs["doc_id"].eqNullSafe(F.col(kept)), "leftsemi")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark. A null or empty text has none; rows equal
    in doc_id and text share their fate."""
    key = fresh(docs, "leak_key")
    found = contamination.leaks(docs.select("text", contamination.row_key().alias("key")), table(spark, sf_dir, "benchmark"))
    found = found.where(F.col("score") >= contamination.THRESHOLD).select(F.col("key").alias(key))
    return docs.withColumn(key, contamination.row_key()).join(found, key, "leftanti").drop(key)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 4096 tokens. A null or empty text
    is an end id alone; equal rows are packed apart."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

# Trained scores, connected components and packing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, after all stages over the table of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
