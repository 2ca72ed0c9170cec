"""Corpus pipeline: quality filter, near duplicates, repeated passages, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on every row
its predecessor kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskspark.llm import packing, quality, secrets, simhash, suffix
from riskspark.llm.common import table, written


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.5 or more."""
    return quality.keep_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: four-word shingles, four bits at most."""
    return simhash.one_of_each(docs, shingle=4, distance=4)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of 100-byte strings that occur earlier."""
    return suffix.without_repeats(docs, length=100)


def secret_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every secret replaced by a mark."""
    return secrets.redact(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the texts, packed into training sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", quality_filter),
    ("SimHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("secret scans", secret_spans),
    ("best-fit packing", sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's rows are written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)


#: Fitted models, trees and merges are beyond SQL; tests/llm holds the stages against plain versions.
ORACLE_SQL = None
