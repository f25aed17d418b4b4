"""Quality counts and distributions.

Distributions are zero-filled by counting every bucket in one aggregate and
turning the single result row into rows; no join against a bucket list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vulnlake.functions.ids import is_valid_id
from vulnlake.functions.scores import NO_SEVERITY, SEVERITY_RANKS, severity_bucket
from vulnlake.functions.sources import SOURCE_TYPES
from vulnlake.functions.text import is_blank, strip

SEVERITY_BUCKETS = [*SEVERITY_RANKS, NO_SEVERITY]
RESOLUTION_BUCKETS = {
    "affected": "resolved_via_affected",
    "cpe_fallback": "resolved_via_cpe_fallback",
    "unresolved": "still_unresolved",
}


def literal_rows(spark: SparkSession, names: list[str], rows: list[tuple]) -> DataFrame:
    """A small table of literals that the optimizer sees as one row expanded."""
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def count_buckets(bucket: Column, names: list[str]) -> list[Column]:
    return [F.count_if(bucket == name).alias(name) for name in names]


def bucket_rows(df: DataFrame, bucket: Column, names: list[str], label: str, value: str = "records") -> DataFrame:
    """One row per bucket, zero-filled, in the order given."""
    pairs = [F.struct(F.lit(n).alias(label), F.col(f"`{n}`").alias(value)) for n in names]
    return df.agg(*count_buckets(bucket, names)).select(F.inline(F.array(*pairs)))


def resolution_bucket(col: Column) -> Column:
    source = strip(col)
    known = [k for k in RESOLUTION_BUCKETS if k != "unresolved"]
    out = F.lit(RESOLUTION_BUCKETS["unresolved"])
    for key in known:
        out = F.when(source == key, F.lit(RESOLUTION_BUCKETS[key])).otherwise(out)
    return out


def source_bucket(col: Column) -> Column:
    source = strip(col)
    return F.when(source.isin(SOURCE_TYPES), source).otherwise(F.lit("other"))


def severity_buckets(df: DataFrame, column: str = "severity") -> DataFrame:
    return bucket_rows(df, severity_bucket(F.col(column)), SEVERITY_BUCKETS, "severity")


def vendor_resolution(df: DataFrame, column: str = "vendor_source") -> DataFrame:
    return bucket_rows(df, resolution_bucket(F.col(column)), list(RESOLUTION_BUCKETS.values()), "resolution")


def source_types(df: DataFrame, column: str = "cve_source_type") -> DataFrame:
    return bucket_rows(df, source_bucket(F.col(column)), SOURCE_TYPES, "source_type")


def missing_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Blank values per column, as one row."""
    return df.agg(*[F.count_if(is_blank(F.col(c).cast("string"))).alias(f"missing_{c}") for c in columns])


def date_range(df: DataFrame, day: str = "published_date", stamp: str = "published") -> DataFrame:
    return df.agg(
        F.min(stamp).alias("min_published"),
        F.max(stamp).alias("max_published"),
        F.min(day).alias("min_published_date"),
        F.max(day).alias("max_published_date"),
    )


def run_counts(df: DataFrame, version: Column, ties: list[Column], key: str = "cve_id") -> DataFrame:
    """Counts before and after the id check and the latest-wins step, in one pass and one shuffle.

    Grouping by key keeps the flags of the newest row only; malformed ids share
    the null group. Task-side counters (``observe``) are avoided on purpose: a
    stage that is run again after a lost executor would count twice.
    """
    flags = F.struct(
        F.col("cvss_score").isNull().alias("score"),
        is_blank(F.col("description_en")).alias("description"),
        is_blank(F.col("vendor")).alias("vendor"),
    )
    order = F.struct(version.alias("o0"), *[t.alias(f"o{i}") for i, t in enumerate(ties, 1)])
    per_key = df.groupBy(F.when(is_valid_id(F.col(key)), F.col(key)).alias("k")).agg(
        F.count(F.lit(1)).alias("n"), F.max_by(flags, order).alias("latest")
    )
    valid = F.col("k").isNotNull()
    total = F.coalesce(F.sum("n"), F.lit(0))
    kept = F.coalesce(F.sum(F.when(valid, F.col("n"))), F.lit(0))
    return per_key.agg(
        total.alias("input_records"),
        F.count("k").alias("output_records"),
        (kept - F.count("k")).alias("duplicate_records_removed"),
        (total - kept).alias("records_dropped_invalid_cve_id"),
        F.count_if(valid & F.col("latest.score")).alias("records_missing_cvss"),
        F.count_if(valid & F.col("latest.description")).alias("records_missing_description"),
        F.count_if(valid & F.col("latest.vendor")).alias("records_missing_vendor"),
    )


def quality_report(deduped: DataFrame, input_records: int, valid_records: int, generated_at: Column) -> DataFrame:
    """The nested one-row report over cleaned rows that still carry ``vendor_source``. One aggregate."""
    severity = count_buckets(severity_bucket(F.col("severity")), SEVERITY_BUCKETS)
    resolution = count_buckets(resolution_bucket(F.col("vendor_source")), list(RESOLUTION_BUCKETS.values()))
    sources = count_buckets(source_bucket(F.col("cve_source_type")), SOURCE_TYPES)

    def nested(names: list[str]) -> Column:
        return F.struct(*[F.col(f"`{n}`").alias(n) for n in names])

    totals = deduped.agg(
        F.count(F.lit(1)).alias("output_records"),
        F.count_if(F.col("cvss_score").isNull()).alias("records_missing_cvss"),
        F.count_if(is_blank(F.col("description_en"))).alias("records_missing_description"),
        F.count_if(is_blank(F.col("vendor"))).alias("records_missing_vendor"),
        F.count_if(F.col("published_date").isNull()).alias("records_bad_published"),
        *severity,
        *resolution,
        *sources,
        F.min("published_date").alias("min_published_date"),
        F.max("published_date").alias("max_published_date"),
    )
    return totals.select(
        F.lit(input_records).cast("bigint").alias("input_records"),
        F.col("output_records"),
        (F.lit(valid_records).cast("bigint") - F.col("output_records")).alias("duplicate_records_removed"),
        F.lit(input_records - valid_records).cast("bigint").alias("records_dropped_invalid_cve_id"),
        F.col("records_missing_cvss"),
        F.col("records_missing_description"),
        F.col("records_missing_vendor"),
        F.col("records_bad_published"),
        nested(list(RESOLUTION_BUCKETS.values())).alias("vendor_resolution"),
        nested(SOURCE_TYPES).alias("source_type_distribution"),
        nested(SEVERITY_BUCKETS).alias("severity_distribution"),
        F.col("min_published_date").cast("string").alias("min_published_date"),
        F.col("max_published_date").cast("string").alias("max_published_date"),
        generated_at.alias("generated_at"),
    )


def long_form(one_row: DataFrame, label: str = "metric", value: str = "value") -> DataFrame:
    """A one-row frame of counts as ``metric, value`` rows."""
    pairs = [F.struct(F.lit(c).alias(label), F.col(f"`{c}`").cast("bigint").alias(value)) for c in one_row.columns]
    return one_row.select(F.inline(F.array(*pairs)))
