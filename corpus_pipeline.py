"""The training-data pipeline: documents in, packed sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as
Parquet and read back as the next one's ``docs``. All but the last return the columns of
``documents``; a stage works on all rows its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repsmith.llm import decontaminate, minhash_dedup, packing, sparse_suffix, toxicity_pu
from repsmith.llm._common import persisted
from repsmith.llm.queries import table, tokenizer

#: Some stages cannot be written in SQL (trained scores, tokenizers); tests compare with brute force.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more by the positive-unlabelled classifier go."""
    return toxicity_pu.without_toxic(docs, toxicity_pu.train(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays; documents without a word are in no group."""
    table(spark, sf_dir, "documents")
    return minhash_dedup.drop_near_duplicates(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more stay where they occur first; ``n_chars`` follows the text."""
    table(spark, sf_dir, "documents")
    before = docs.withColumn("n_chars", F.when(F.length("text") == F.col("n_chars"), F.lit(None)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    cut = sparse_suffix.without_repeats(before)
    return cut.withColumn("n_chars", F.coalesce("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents holding a copy or an edited copy of a benchmark item go."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the tokenised documents with their sequence and offset."""
    table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, tokenizer("word_bpe_49k.json"))


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages), ("decontamination", decontamination), ("sequences", sequences)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``, each written to the shared folder and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = persisted(stage(spark, docs, sf_dir), name)
    return docs
