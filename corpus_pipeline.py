"""Corpus pipeline: quality rules, exact dedup, near dedup, mixing, encoding, each stage over all that the last one kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vulnlake.llm import common, stages

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", stages.quality),
    ("exact_dedup", stages.exact),
    ("near_dedup", stages.near),
    ("mixing", stages.mixture),
    ("bpe", stages.encode),
]

#: The stages hash words, fit a model and encode with a vocabulary file, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again before the next stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = common.stage(apply(spark, docs, sf_dir), common.scratch(spark, name))
    return STAGES[-1][1](spark, docs, sf_dir)
