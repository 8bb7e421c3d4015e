"""The training-data pipeline over ``documents``: STAGES in order, each written and read again.

Every stage works on all rows that the one before has kept, and all but the last return the columns that they get.
Columns of documents come through whatever they are called; a stage's own columns never meet them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketshift.llm import bpe, cuckoo, decontaminate, minhash, toxicity
from basketshift.llm.common import boxed, keep_rows, prepare, table, unboxed
from basketshift.session import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is under 0.5, by the lexicon that the labels support.

    Null and empty texts have the score of a text without hits; repeated rows stay or go together; without labels of both kinds, and of an
    empty table, nothing goes.
    """
    scored = toxicity.toxicity(boxed(docs, "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return unboxed(scored.where("predicted = 0"), docs, "doc_id", "text")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, up to the case of A-Z, the row of the largest doc_id.

    Null texts count as empty, and all empty texts are equal; a null doc_id is smaller than all others; of repeated rows one stays.
    """
    return keep_rows(docs, cuckoo.exact_dedup(docs.select("doc_id", "text")).where("kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group linked by 80 % of their five-word shingles.

    Texts without words, null ones included, are linked with nothing; a null doc_id is larger than all others; of repeated rows one stays.
    """
    groups = minhash.near_groups(docs.select("doc_id", "text"), minhash.MinHashParams(shingle=5))
    return keep_rows(docs, groups.where(F.col("first")))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark item, as it is or lightly edited. Null and empty texts hold none; repeated rows stay or go together."""
    prepare(spark)
    clean = decontaminate.without_items(boxed(docs, "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))
    return unboxed(clean, docs, "doc_id", "text")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, repeated rows each; a null text counts as empty and has none."""
    prepare(spark)
    return bpe.encode_texts(docs)


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies), ("decontamination", drop_contaminated),
          ("bpe", encode)]

# Learned scores, groups, edit distance and token ids have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
