"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and returns a table that is written as Parquet and read again as the next one's
docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from statkit.llm import exact_dup, mixing, near_dup, packing, quality
from statkit.llm.common import stored, table
from statkit.llm.queries import MIX_WEIGHTS


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained quality classifier does not reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text: the smallest doc_id."""
    return exact_dup.drop_exact_duplicates(docs, keep="smallest")


def near_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (word 5-shingles, similarity 0.8 or more): the smallest doc_id."""
    return near_dup.drop_near_duplicates(docs, width=5, percent=80)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them (a row per copy)."""
    return mixing.mixed_documents(docs, MIX_WEIGHTS, share=1.5, most=2.0)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 2048 tokens."""
    return packing.pack(docs, capacity=2048, words=120_000)


STAGES = [("quality", good_quality), ("exact_dedup", exact_once), ("near_dedup", near_once), ("mix", mixed), ("pack", packed)]
ORACLE_SQL = None  # the classifier and the seeded sample are not expressible in SQL; tests/llm/test_pipeline.py checks each stage


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
