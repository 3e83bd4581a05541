"""Corpus pipeline: toxicity, exact dedup, SimHash near-dedup, mixing, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that its
predecessor kept; ``run`` writes every stage's rows as Parquet in the shared
folder and reads them again as the next one's ``docs``. All stages but the last
return the columns of ``documents``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sifter.llm.common import stage, table
from sifter.llm.exact_dedup import drop_copies
from sifter.llm.mixing import mix_rows
from sifter.llm.packing import pack
from sifter.llm.simhash import keep_one
from sifter.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under 0.5 by a model fitted on the labels of these documents."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked at 4 or fewer SimHash bits (4-word shingles), the one with the smallest doc_id."""
    return keep_one(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents up to each source's share of 0.9 of all tokens; none twice, as copies have just been removed."""
    return mix_rows(docs, share=0.9, max_epochs=1)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of at most 1024 tokens, with its sequence and offset."""
    return pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

ORACLE_SQL = None  # FTRL training, SimHash and tokenisation can't be said in SQL; tests/llm holds it to brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
