"""A corpus pipeline: toxic documents go, then poor ones, then near copies; what stays is batched by length."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpuslens.llm import length_buckets, quality, simhash, toxicity
from corpuslens.llm.common import table
from corpuslens.session import cut_lineage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labels of four folds out of five, doesn't call toxic."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line rules keep, with their whole texts."""
    return quality.keep_good(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, which op1's fingerprints or a 5-word similarity of 0.8 link."""
    return simhash.keep_one(docs, simhash.all_copies)


def batch(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bucket, batch and slot of each document that is left."""
    return length_buckets.pack_words(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("near_duplicates", drop_copies),
    ("packing", batch),
]

#: The first stage is learned, and the third needs 64-bit hashes: SQL has neither.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each is written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
