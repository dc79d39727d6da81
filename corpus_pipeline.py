"""The corpus pipeline: documents to packed training sequences.

Each stage works on all rows the one before kept, and its result is written and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from meetlake.llm import mixing, packing, quality, simhash, toxicity
from meetlake.llm.common import table
from meetlake.session import staged, tune


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    tune(spark)
    return quality.kept(docs)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic; the labels stand beside the documents."""
    tune(spark)
    return toxicity.kept(docs, table(spark, sf_dir, "labels"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: 0.8 of their 5-word shingles in common.

    Operator 3's Golay keys of fingerprints find the first of them, `jaccard` those they miss.
    """
    tune(spark)
    return simhash.kept(docs, words=5, similarity=0.8)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    tune(spark)
    return mixing.repeated(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed documents with their sequences."""
    tune(spark)
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("dedup", dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Trained models decide in the first stages, so SQL cannot state the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written as Parquet and read again for the next."""
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        rows = staged(stage(spark, rows, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, rows, sf_dir)
