"""The corpus pipeline: language ID, toxicity, near-dedup, mixing, packing, each over all its predecessor kept.

Every stage is landed as Parquet in the shared folder and read again, so a lost executor costs at most one stage's work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from payrisk.llm.common import land, table
from payrisk.llm.langid import language_stage
from payrisk.llm.minhash import dedup_stage
from payrisk.llm.mixing import mixing_stage
from payrisk.llm.packing import packing_query
from payrisk.llm.toxicity import toxicity_stage


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or whose language is less than a quarter certain, go."""
    return language_stage(docs)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored toxic at 0.7 or more go."""
    return toxicity_stage(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return dedup_stage(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document once for every epoch in which the mix takes it."""
    return mixing_stage(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens."""
    return packing_query(docs)


STAGES = [("language", language), ("toxicity", toxicity), ("near_dedup", near_dedup), ("mixing", mixing), ("packing", packing)]
#: Models and similarity joins have no SQL form; tests/llm/test_llm_pipeline.py holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
