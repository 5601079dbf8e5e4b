"""The training-corpus pipeline: documents through five stages, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from homespan.llm import decontaminate, pii, quality, simhash, trie_bpe
from homespan.llm.queries import tokenizer_path
from homespan.session import fresh_path


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that the base rules or their cell's thresholds reject."""
    return quality.keep_good(docs)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs)


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def private_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With personal data replaced by its kind; n_chars follows the new text."""
    return pii.redacted(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def encoded_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids and the number of these."""
    return docs.withColumn("token_ids", trie_bpe.encoded(F.col("text"), tokenizer_path())).withColumn(
        "n_tokens", F.size("token_ids").cast("long"))


STAGES = [("quality_rules", good_documents), ("simhash_near_dedup", distinct_documents),
          ("benchmark_decontamination", clean_documents), ("pii", private_documents), ("bpe", encoded_documents)]

#: Sketched thresholds, connected components, trained trees and byte-pair merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents of a folder; the last stage's rows."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
