"""Corpus pipeline over ``documents``: quality, near-duplicates, benchmark passages, secrets, tokens.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor
kept; its result is written as Parquet in the shared folder and read again as the
next stage's docs. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomstream.llm import bpe, decontaminate, neardup, quality, secrets
from loomstream.llm.common import saved, table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labelled ones among them."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, that of the smallest doc_id."""
    return neardup.first_of_each(docs)


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no item of ``benchmark`` stands."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def masked_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets masked."""
    return secrets.without_secrets(docs)


def token_digests(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The encoded documents: number of tokens, digests of ids and of the decoded text."""
    return bpe.encoded_digests(docs)


STAGES = [
    ("quality classifier", good_documents),
    ("MinHash near-dedup", distinct_documents),
    ("benchmark decontamination", clean_documents),
    ("secret scans", masked_documents),
    ("BPE encoding and decoding", token_digests),
]

#: Training trees, alignment and merging ids are beyond SQL; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
