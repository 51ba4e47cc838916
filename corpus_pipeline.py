"""A corpus from raw documents to tokens, stage by stage; each stage's rows are written and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlake.llm import near_duplicates, pii_patterns, positional_index, toxicity
from grantlake.llm.common import table
from grantlake.llm.queries import token_digests
from grantlake.session import remove_path, scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier scores below 0.3."""
    return toxicity.kept(docs, table(spark, sf_dir, "labels"))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest doc_id."""
    return near_duplicates.deduplicated(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth stands in benchmark items."""
    return positional_index.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind and n_chars put right."""
    masked = pii_patterns.masked(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else masked


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document doc_id, n_tokens and the digests of its ids and of what they decode to."""
    return token_digests(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", without_benchmarks),
    ("pii", without_personal_data),
    ("sentencepiece", as_tokens),
]

#: Learned scores and hashed sketches have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    rows, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, rows, sf_dir).write.parquet(path)
        rows = spark.read.parquet(path)
        if before:
            remove_path(spark, before)
        before = path
    return rows
