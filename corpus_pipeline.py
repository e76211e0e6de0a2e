"""Corpus pipeline over ``documents``: each stage works on what the stage before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's docs. All but the last return the columns of ``documents``. Languages are
classified by a model that is trained on the way, which SQL cannot express, so there is no SQL for
the whole; tests hold it against plain versions of the stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.llm.common import table, written
from ferry.llm.decontaminate import decontaminate
from ferry.llm.jaccard import JoinParams, keep_one_per_component
from ferry.llm.language import language_filter
from ferry.llm.packing import pack_documents, text_cluster, word_length
from ferry.llm.quality import quality_filter


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that fail the base rules or are outliers of their language and source."""
    return quality_filter(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter or of no recognisable language."""
    return language_filter(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group linked by 5-word shingles at a similarity of 0.8 or more."""
    return keep_one_per_component(docs, JoinParams(words=5, percent=80))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of which a twentieth or more are benchmark passages."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place every piece of every document in a training sequence."""
    text = F.col("text")
    return pack_documents(docs, word_length(text), text_cluster(text)).drop("row")


STAGES = [
    ("quality rules", quality_rules),
    ("language ID", language_id),
    ("near copies", near_copies),
    ("decontamination", decontamination),
    ("packing", packing),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
