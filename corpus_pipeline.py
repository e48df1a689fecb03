"""The corpus pipeline: language, near duplicates, benchmark items, secrets, mixture.

Each stage takes the documents that its predecessor kept, written and read again, and returns documents; the last adds
how often the mix takes each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accountwise.llm import decontaminate, language, mixing, near_dedup, secret_scan
from accountwise.llm.texts import bucket, stored, tables


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; texts that are null, empty or without a letter go."""
    return language.recognised(docs, bucket("doc_id", 3) != 1)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, that with the least id."""
    return near_dedup.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.clean(docs, tables(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of every secret; n_chars follows."""
    out = secret_scan.redacted(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with mix_copies and mix_target."""
    return mixing.drawn(docs)


STAGES = [
    ("language", identified), ("near_duplicates", deduplicated), ("decontamination", decontaminated),
    ("secrets", without_secrets), ("mixture", mixed),
]

#: The stages learn and sample; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
