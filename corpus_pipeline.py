"""The corpus pipeline: quality, toxicity, near-duplicates, packing; each stage on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from veilframe.llm import packing, quality, simhash, toxicity
from veilframe.llm.common import shared_dir, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label classifier finds good."""
    return quality.keep_good(docs, quality.fit(docs))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the counterfactual-regularised classifier does not find toxic."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of the smallest id, of each near-duplicate group over five-word shingles."""
    return simhash.keep_one(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A place in a sequence for every byte-level token of every document."""
    return packing.pack(docs)


STAGES = [("quality", quality_stage), ("toxicity", toxicity_stage), ("simhash", simhash_stage), ("packing", packing_stage)]

#: The classifiers and fingerprints have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    import uuid

    docs, folder = table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
