"""Comparing two results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reconcile(a: DataFrame, b: DataFrame, key: str = "metric", value: str = "value") -> DataFrame:
    """Two ``metric, value`` frames side by side; a metric only one side has does not match."""
    left = a.select(key, F.col(value).alias("left_value"))
    right = b.select(key, F.col(value).alias("right_value"))
    return left.join(right, key, "full_outer").withColumn(
        "matches", F.coalesce(F.col("left_value") == F.col("right_value"), F.lit(False))
    )


def reconcile_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows only one side has, with their multiplicity kept. One aggregate over both sides."""
    columns = [F.col(f"`{c}`") for c in a.columns]
    sign = "_sign"
    both = a.withColumn(sign, F.lit(1)).unionAll(b.select(*columns).withColumn(sign, F.lit(-1)))
    surplus = both.groupBy(*columns).agg(F.sum(sign).alias(sign)).where(F.col(sign) != 0)
    side = F.when(F.col(sign) > 0, "left").otherwise("right")
    copies = F.array_repeat(side, F.abs(F.col(sign)).cast("int"))
    return surplus.select(*columns, F.explode(copies).alias("side"))
