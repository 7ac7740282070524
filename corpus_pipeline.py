"""From raw documents to packed training sequences, in five stages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yieldlens.llm import contamination, jaccard, packing, quality, secrets
from yieldlens.llm.storage import Workspace

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

TOKENIZER, LENGTH, END_ID = "byte_bpe_50k.json", 1024, 2
ALIKE = jaccard.Alike(width=5, per_cent=80)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.good_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links join, the one with the smallest id stays."""
    return jaccard.one_of_each(docs, ALIKE)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go."""
    return contamination.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets give way to a mark; no document goes."""
    return secrets.redacted(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for every piece of a document: its sequence and its place there."""
    return packing.pack_documents(docs, TOKENIZER, LENGTH, END_ID)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]

# Token ids are beyond SQL; tests/llm/test_pipeline.py holds every stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each reads what the one before has written."""
    space = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = space.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
