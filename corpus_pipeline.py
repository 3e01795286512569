"""A corpus pipeline: documents in, cleaned and mixed documents out.

Each stage takes ``(spark, docs, sf_dir)`` and returns a frame that is written as Parquet and read again as the next
stage's documents. Every stage works on all that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wattline.llm import decontaminate, jaccard, mixing, quality, toxicity
from wattline.llm.common import table
from wattline.streaming.storage import run_dir


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior of being good, from their text and their site, is at least one half."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    judged = quality.posteriors(docs, model, *quality.document_site())
    return judged.where(~judged.rejected).select(*[f"`{name}`" for name in docs.columns])


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below the threshold of their language."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    judged = toxicity.judge(docs, model)
    return judged.where(~judged.toxic).select(*[f"`{name}`" for name in docs.columns])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near duplicates: five-word shingles, similarity 0.8 or more."""
    return jaccard.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their place in a mix of tempered source weights."""
    return mixing.mix(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("toxicity", toxicity_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources to target weights", mixing_stage),
]

#: The trained stages can't be stated in SQL; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over ``documents``."""
    folder = run_dir(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
