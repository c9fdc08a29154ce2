"""From raw documents to training sequences: five stages, each written as a table and read again.

``STAGES`` lists (name, function). A function takes (spark, docs, sf_dir) and returns a DataFrame that the next one
gets as its docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession

from fraudlens.llm import mixing, packing, quality, simhash, suffix_dedup
from fraudlens.session import stage

# No SQL: the trees of the classifier, XXH64 and the tokenizer have none. Tests hold run() against plain loops.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from the labelled rows of ``docs``."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.drop_rejected(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest doc_id, of each group of near copies."""
    return simhash.keep_first(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of passages of over 50 words, of 200 bytes at least, or of 400 bytes."""
    return suffix_dedup.drop_later_copies(docs, 200, words=51)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of documents whose tokens follow raked source, language and topic shares."""
    return mixing.sample(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4096 tokens, with their ids."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("mixing to target weights", mix_sources),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, on the table of documents; what a stage returns is staged as Parquet."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
