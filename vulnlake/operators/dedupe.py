"""One row per key.

All operators rank with ``row_number`` and keep the first. Spark turns that
shape into a group limit on both sides of the shuffle, so a task sends at most
one row per key and a key that holds a third of all rows stays harmless.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vulnlake.functions.dates import to_instant
from vulnlake.functions.ids import is_valid_id

_RANK = "_rank"

# Columns that depend on the day of the run, not on the record: no tie is decided by them.
RUN_COLUMNS = {"days_since_published"}


def first_per(df: DataFrame, keys: list[str | Column], order: list[Column]) -> DataFrame:
    """First row per key in an explicit order. Give a total order for a repeatable result."""
    ranked = df.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK)


def latest_wins(df: DataFrame, key: str, version: Column, ties: list[Column]) -> DataFrame:
    """Newest row per key; null versions lose; ``ties`` decide among equal versions, largest first."""
    order = [version.desc_nulls_last(), *[t.desc_nulls_last() for t in ties]]
    return first_per(df, [key], order)


def version_order(df: DataFrame, column: str = "last_modified") -> tuple[Column, list[Column]]:
    """Version and tie-breakers of ISO-text versions: instant, then text, then the record's own content."""
    content = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns if c not in RUN_COLUMNS])
    return to_instant(F.col(column)), [F.col(column), content]


def latest_records(df: DataFrame, key: str = "cve_id", column: str = "last_modified") -> DataFrame:
    """:func:`latest_wins` on an ISO-text version column."""
    version, ties = version_order(df, column)
    return latest_wins(df, key, version, ties)


def newest_versions(df: DataFrame, key: str, column: str) -> DataFrame:
    """Per well-formed id its newest version and how many rows it has; rows of malformed ids share the null row."""
    return df.groupBy(F.when(is_valid_id(F.col(key)), F.col(key)).alias("_key")).agg(
        F.max(to_instant(F.col(column))).alias("_version"), F.count(F.lit(1)).alias("_rows")
    )


def newest_only(df: DataFrame, versions: DataFrame, key: str, column: str) -> DataFrame:
    """Rows of well-formed ids that bear their id's newest version, ties and all; where no version of an id can be read, all its rows.

    ``versions`` is :func:`newest_versions` as written and read again; Spark would look an outer column up below a projection first. It
    is asked by a filter, not by a join: a filter sinks below the projections that build the rows, so only the rows
    it leaves are built. Ids alone are joined, so that a version is read once a row.
    """
    bears = F.col("_version").isNull() | (to_instant(F.col(column).outer()) >= F.col("_version"))
    return df.where(versions.where((F.col("_key") == F.col(key).outer()) & bears).exists())


def batch_dedupe(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """First row per non-null key; rows without a key are all kept and never shuffled."""
    keyed = first_per(df.filter(F.col(key).isNotNull()), [key], order)
    return keyed.unionByName(df.filter(F.col(key).isNull()))


def duplicate_count(df: DataFrame, key: str) -> DataFrame:
    """How many rows :func:`batch_dedupe` drops, as one row."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicates"))
    )


def duplicate_ids(df: DataFrame, key: str) -> DataFrame:
    """Keys seen more than once, sorted; nulls are ignored."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter(F.col("copies") > 1)
        .orderBy(key)
    )


def insert_if_absent(
    new: DataFrame, stored: DataFrame, key: str, order: list[Column]
) -> DataFrame:
    """Rows of ``new`` whose key is not stored yet, one per key, the first in ``order``.

    The stored side is only asked which of the new keys it holds. That answer is
    never larger than ``new``, so it, not the ever-growing store, is what the
    anti-join has to distribute. Whether keys are broadcast is left to measured sizes.
    """
    fresh = first_per(new, [key], order)
    held = stored.select(key).join(fresh.select(key), key, "left_semi").distinct()
    return fresh.join(held, key, "left_anti")


def upsert_latest(
    base: DataFrame, increment: DataFrame, key: str, version: Column, ties: list[Column]
) -> DataFrame:
    """The base with an increment merged in, newest row per key.

    Base rows the increment does not touch pass through; only contested keys are
    ranked. Where the measured size of the keys allows a broadcast, the base is not shuffled.
    """
    keys = increment.select(key).distinct()
    untouched = base.join(keys, key, "left_anti")
    contested = base.join(keys, key, "left_semi").unionByName(increment)
    return untouched.unionByName(latest_wins(contested, key, version, ties))
