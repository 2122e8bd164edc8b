"""From raw documents to packed training sequences.

``STAGES`` are (name, function) pairs; each function takes (spark, docs,
sf_dir) and returns a DataFrame, which is written as Parquet and read again as
the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from matchmart.llm import exact_dedup, mixing, near_dedup, packing, quality
from matchmart.llm.common import dropped, staged, table

#: Token weights of the mix; what the labels call low quality is left to the
#: quality stage.
MIX = {"clean": 0.98, "toxic": 0.02}


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak supervision of the rules rejects go."""
    return quality.keep_rows(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays."""
    return exact_dedup.keep_rows(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return near_dedup.keep_rows(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are drawn at the fitted rates, none more than once."""
    return mixing.sample(docs, table(spark, sf_dir, "labels"), MIX)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in training sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: The quality verdict and the mixing rates are fitted, so SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
        if before is not None:
            dropped(before)
        before = docs
    return docs
