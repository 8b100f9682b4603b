"""Corpus pipeline: five stages over ``documents``, each one operator of ``chatlake.llm``.

``run`` writes each stage's result as Parquet to the shared scratch folder and
reads it back as the next one's input, so a stage never recomputes its
predecessors, whatever executor is lost. All but the last stage return the rows
that they keep, with the columns that they got.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chatlake.llm import exact_dedup, ngram_join, packing, quality_rules, toxicity
from chatlake.llm.common import ship, stored, table

#: Near duplicates share 80 % of their five-word shingles.
WORDS, SHARE = 5, (80, 100)


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic, by a model learned from ``labels``."""
    ship(spark)
    return toxicity.keep(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def with_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the standard policy of the quality rules."""
    ship(spark)
    return quality_rules.keep(docs, quality_rules.STANDARD)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact_dedup.drop_duplicates(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the smallest id."""
    ship(spark)
    return ngram_join.keep_one(docs, WORDS, SHARE)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the packed sequences."""
    ship(spark)
    return packing.pack(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("quality rules", with_quality),
    ("exact dedup", without_copies),
    ("n-gram Jaccard join", without_near_copies),
    ("best-fit packing", packed),
]

#: The toxicity model and the packing have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
