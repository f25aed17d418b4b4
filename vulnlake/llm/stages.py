"""Stages of the corpus pipeline: each applies one operator and returns the documents it keeps."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vulnlake.llm import bpe, common, exact_dedup, mixing, near_dedup, quality_rules


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the newest policy accepts."""
    into = common.free_name(docs, "measures")
    judged = quality_rules.measured(docs, "text", into)
    bits = quality_rules.failure_bits(into)
    return judged.where(quality_rules.accepted(bits, max(quality_rules.POLICIES))).select(docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: the smallest id; of repeated rows one."""
    digest = common.free_name(docs, "digest")
    rows = common.stage(exact_dedup.digests(docs), common.scratch(spark, "digests"))
    index = exact_dedup.DigestIndex(spark, common.scratch(spark, "digest-index"), buckets=32)
    index.add(0, rows)
    held, keep = common.free_name(docs, "held_digest"), common.free_name(docs, "held_keep")
    kept = index.rows().select(F.col("digest").alias(held), F.col("keep_id").alias(keep))
    marked = docs.withColumn(digest, F.sha2(exact_dedup.normalized(F.col("text")), 256)).dropDuplicates(["doc_id", digest])
    same = F.col(digest).eqNullSafe(F.col(held)) & F.col("doc_id").eqNullSafe(F.col(keep))
    return marked.join(kept, same, "left_semi").select(docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five words, 0.8): the smallest id."""
    groups = near_dedup.near_groups(docs, "doc_id", "text", size=5, percent=80)
    name = common.free_name(docs, "extra_id")
    extra = groups.where(~F.col("kept")).select(F.col("doc_id").alias(name)).distinct()
    extra = common.stage(extra, common.scratch(spark, "near-extra"))
    return docs.join(extra, F.col("doc_id") == F.col(name), "left_anti").select(docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rates say: toxic and poor ones seldom, clean ones at least once. Rows without id stay once."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rates = mixing.mixed(docs, mixing.domains_of(labels), mixing.MIXTURE)
    key, n, each = (common.free_name(docs, c) for c in ("rated_id", "rated_copies", "rated_copy"))
    rates = rates.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias(key)).agg(F.max("copies").alias(n))
    rates = common.stage(rates, common.scratch(spark, "copies"))
    copies = F.explode(F.array_repeat(F.lit(0), F.coalesce(n, F.lit(1))))
    return docs.join(rates, F.col("doc_id") == F.col(key), "left").select(*docs.columns, copies.alias(each)).drop(each)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, their number, and the digests of ids and of what they decode to."""
    return bpe.round_trip(docs, bpe.share(spark, public_tokenizers.path(bpe.VOCABULARY)), keep_ids=True)
