"""The corpus pipeline: toxicity, exact dedup, near duplicates, secrets, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that its
predecessor kept; ``run`` writes its result as Parquet in the shared folder and
reads it back as the next stage's documents. All stages but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.llm import exact_dedup, ngram_join, packing, secret_scan, toxicity
from newsflow.llm.queries import table, tokenizer
from newsflow.llm.store import stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier (learned from ``labels``) does not predict toxic."""
    weights = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, weights).filter("predicted = 0").select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per text, white space aside."""
    return exact_dedup.keep_one(docs).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per group of linked documents (runs of five words, similarity 0.8 or more)."""
    return ngram_join.keep_one(docs).select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row, with each secret in its text replaced by a mark; ``n_chars`` follows the text."""
    return secret_scan.mask(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(
        *docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens, placed in sequences."""
    return packing.pack_documents(docs, tokenizer("word_bpe_49k.json"))


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("ngram_join", drop_near_copies),
          ("secret_scan", mask_secrets), ("packing", pack)]

#: The learned classifier and the tokenizer cannot be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
