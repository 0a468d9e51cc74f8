"""The corpus pipeline: from raw documents to packed sequences.

Every stage works on all that the one before it kept; the first four drop documents and keep all
columns, the last gives the pieces of the sequences. What each does with nulls, ties and repeated
rows is told by its operator. SQL cannot say these stages; tests hold them against plain code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import decontaminate, exact_dedup, language_id, ngram_join, packing
from shelfwise.scratch import scratch_path

# A document goes if no language holds this share of it.
LEAST_SHARE = 0.4


def in_a_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that have no letters or no main language."""
    return language_id.with_language(docs, LEAST_SHARE)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact_dedup.without_duplicates(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar texts."""
    return ngram_join.one_of_each_group(docs)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold benchmark items."""
    return decontaminate.without_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the remaining documents in sequences."""
    return packing.pack(docs)


STAGES = [
    ("language ID", in_a_language),
    ("exact dedup", one_of_each),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", clean_of_benchmark),
    ("packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sequences of ``documents``; each stage's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
