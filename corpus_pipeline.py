"""Corpus pipeline: toxicity, exact dedup, near dedup, source mixing, packing.

Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet and read
again as the next stage's ``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridloom.llm import exact_dedup, minhash, mixing, packing, toxicity
from gridloom.llm.common import stage, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose whole text scores below 0.3; the classifier learns from ``labels``."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest id."""
    return exact_dedup.drop_copies(docs, keep="max")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component at 0.8 on five-word shingles, the smallest id."""
    return minhash.drop_near_copies(docs, size=5, num=80, den=100)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents drawn to the target weights; a document drawn twice is two rows."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 ids with their place in a sequence."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

ORACLE_SQL = None  # classifier, minima and packing are beyond SQL; tests hold the rows of each stage against plain Python


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, step) in enumerate(STAGES):
        out = step(spark, docs, sf_dir)
        docs = out if k == len(STAGES) - 1 else stage(out, f"pipeline-{name}")
    return docs
