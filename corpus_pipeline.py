"""The corpus pipeline: quality, near duplicates, decontamination, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns a
DataFrame, which is written as Parquet and read again as the docs of the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ebbtide.llm.common import materialise, table
from ebbtide.llm.decontamination import decontaminated
from ebbtide.llm.jaccard import one_of_each
from ebbtide.llm.packing import pack_documents
from ebbtide.llm.quality import accepted


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    return accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a test item."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the remaining documents in sequences of 4,096 tokens."""
    return pack_documents(docs)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", packing),
]

#: A trained classifier is not SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
