"""Exact dedup against a persistent digest index.

The index is a table of digests, bucketed and sorted by digest and partitioned by batch. New rows are reduced to
one row per digest, joined to the index by a sort-merge anti-join (the index side needs no shuffle: it is stored in
buckets), and what is new is appended. A batch can be run again after a failure: it replaces its own partition
and ignores what it wrote before.

Edge cases: null text counts as empty, and empty texts equal each other; of equal texts within a batch the smallest
id stays, over batches the one of the earlier batch; rows with a null id come after all others and stay only where
no other has their text; repeated rows count in the group's size; an empty batch appends nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vulnlake.llm.common import WHITE


def normalized(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"[{WHITE}]+", " ")


class DigestIndex:
    """Digests seen so far, kept at ``path`` on shared storage; opening an existing path goes on with it."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark = spark
        self.table = f"digest_index_{uuid.uuid4().hex}"
        empty = spark.range(0).selectExpr("'' AS digest", "id AS keep_id", "0 AS batch")
        empty.write.mode("append").partitionBy("batch").parquet(path)  # an existing index stays as it is
        spark.sql(
            f"CREATE TABLE {self.table} (digest STRING, keep_id BIGINT, batch INT) USING parquet PARTITIONED BY (batch) "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
        self.refresh()

    def refresh(self) -> None:
        self.spark.sql(f"MSCK REPAIR TABLE {self.table}")
        self.spark.catalog.refreshTable(self.table)

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def add(self, batch: int, digests: DataFrame) -> None:
        """Append the digests of ``digests`` (``doc_id``, ``digest``) that no other batch has.

        The join leaves its rows in the index's own partitioning, so a task writes the file of one bucket.
        """
        fresh = digests.groupBy("digest").agg(F.min("doc_id").alias("keep_id"))
        known = self.rows().where(F.col("batch") != batch).select("digest")
        new = fresh.join(known.hint("merge"), "digest", "left_anti")
        mode = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(mode)
        self.spark.conf.set(mode, "dynamic")  # only the batch's own partition is replaced
        try:
            new.select("digest", "keep_id", F.lit(batch).cast("int").alias("batch")).write.insertInto(self.table, overwrite=True)
        finally:
            self.spark.conf.set(mode, before)
        self.refresh()

    def decide(self, digests: DataFrame) -> DataFrame:
        """``keep_id``, ``group_size`` and ``kept`` for every row of ``digests``.

        Group sizes are counted before the join; a digest that many rows share is split by the skew join.
        """
        sizes = digests.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"))
        groups = self.rows().select("digest", "keep_id").join(sizes, "digest")
        return digests.join(groups, "digest").withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def digests(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", F.sha2(normalized(F.col("text")), 256).alias("digest"))
