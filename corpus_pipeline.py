"""Corpus pipeline: quality rules, exact dedup, near dedup, surrogates for personal data, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from variantlink.llm import common, exact_dedup, packing, pii, quality, queries, simhash


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression bands keep, each row by itself. Null and empty texts have no words and go."""
    return quality.keep_good(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id; of repeated rows one."""
    return exact_dedup.keep_first_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component the document with the smallest id, its repeated rows all.

    Null and empty texts have fingerprint zero, linked like any other; a null id stays where its component holds no other.
    """
    return simhash.keep_one_each(docs)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data and their new length; null texts stay null."""
    return pii.replaced(docs, queries.SURROGATE_KEY)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their token ids and places in the training sequences.

    Null and empty texts give one piece of one token; repeated rows are packed each.
    """
    return packing.pack(docs, queries.tokenizer_file("byte_bpe_50k.tiktoken"), with_ids=True)


STAGES = [
    ("quality", quality_rules),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("pii", private_data),
    ("packing", packed),
]

#: SQL can express neither zstd ratios, SimHash components nor packing; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
