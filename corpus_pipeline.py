"""A training corpus from the documents table: known languages, no copies, no near copies, no benchmark text, packed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plumbline.llm import decontaminate, exact_dedup, jaccard_join, language, packing
from plumbline.llm.storage import written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the fused evidence accepts."""
    return language.in_known_language(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of equal texts: the longest, then the smallest id."""
    return exact_dedup.without_duplicates(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every component of texts whose five-word shingles are four fifths alike: the smallest id."""
    return jaccard_join.one_of_each(docs, words=5, num=4, den=5)


def benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark passages are less than a twentieth."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def length_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bucket, batch and slot of every document that is left."""
    return packing.packed(docs)


STAGES = [
    ("language ID", language_id), ("exact dedup", exact_copies), ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", benchmark_text), ("packing", length_packing),
]
# Components, language scores and the choice of buckets are iterative, so SQL has no counterpart; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each result written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    name, stage = STAGES[-1]
    return written(stage(spark, docs, sf_dir), "pipeline-" + name)
