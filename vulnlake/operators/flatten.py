"""Nested record to flat row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vulnlake.functions.dates import date_parts, days_since, to_day
from vulnlake.functions.metrics import pick_metrics
from vulnlake.functions.products import affected_entries, affected_status, first_cpe, parse_cpe, select_entry
from vulnlake.functions.scores import severity_rank
from vulnlake.functions.sources import source_type
from vulnlake.functions.text import clean_placeholder, first_nonblank, flatten_safe, join_distinct

RESOLVED_COLUMNS = ["vendor", "product", "cpe_uri", "affected_status", "affected_version_range", "vendor_source"]


def first_lang(descriptions: Column, lang: str = "en") -> Column:
    """Text of the first description in a language; null when there is none."""
    return F.try_element_at(F.filter(descriptions, lambda d: d["lang"] == lang), F.lit(1))["value"]


def weakness_ids(weaknesses: Column) -> Column:
    """All weakness ids, distinct, first-seen order, comma separated."""
    return join_distinct(flatten_safe(weaknesses, lambda w: F.transform(w["description"], lambda d: d["value"])))


def flatten(records: DataFrame, coherent: bool = False) -> DataFrame:
    """Flat scalar columns; the two product arrays are kept for :func:`resolve_products`."""
    metrics = pick_metrics(F.col("metrics"), coherent)
    return records.select(
        F.col("id").alias("cve_id"),
        F.col("published"),
        F.col("lastModified").alias("last_modified"),
        F.col("vulnStatus").alias("vuln_status"),
        first_lang(F.col("descriptions")).alias("description_en"),
        *[column.alias(name) for name, column in metrics.items()],
        weakness_ids(F.col("weaknesses")).alias("cwe_ids"),
        F.col("sourceIdentifier").alias("source_identifier"),
        F.col("affected"),
        F.col("configurations"),
    )


def resolve_products(df: DataFrame, escaped_cpe: bool = False) -> DataFrame:
    """Replace ``affected`` and ``configurations`` by the resolved product columns.

    Affected-product entries come first; the CPE name fills vendor, product and
    URI each on its own. The steps are separate projections so that each array
    is walked once and its result reused.
    """
    entry, cpe = F.col("_entry"), F.col("_cpe")
    own = {name: F.nullif(F.col(f"_own_{name}"), F.lit("")) for name in ("vendor", "product", "cpe")}

    def filled(first: Column, second: Column) -> Column:
        return F.coalesce(first, F.nullif(second, F.lit("")), F.lit(""))

    staged = (
        df.withColumns({"_entries": affected_entries(F.col("affected")), "_uri": first_cpe(F.col("configurations"))})
        .withColumns(
            {
                "_entry": select_entry(F.col("_entries")),
                "_cpe": parse_cpe(F.col("_uri"), escaped_cpe),
                "affected_status": affected_status(F.col("_entries")),
            }
        )
        .withColumns(
            {
                "_own_vendor": clean_placeholder(entry["vendor"]),
                "_own_product": clean_placeholder(entry["product"]),
                "_own_cpe": first_nonblank(entry["cpes"]),
                "affected_version_range": first_nonblank(F.transform(entry["versions"], lambda v: v["version"])),
            }
        )
        .withColumns(
            {
                "vendor": filled(own["vendor"], cpe["vendor"]),
                "product": filled(own["product"], cpe["product"]),
                "cpe_uri": filled(own["cpe"], F.col("_uri")),
                "vendor_source": F.when(own["vendor"].isNotNull(), F.lit("affected"))
                .when(cpe["vendor"] != "", F.lit("cpe_fallback"))
                .otherwise(F.lit("unresolved")),
            }
        )
    )
    return staged.drop(
        "affected", "configurations", "_entries", "_entry", "_uri", "_cpe", "_own_vendor", "_own_product", "_own_cpe"
    )


def enrich(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Calendar columns, severity rank and source type of flat rows."""
    day = F.col("published_date")
    return df.withColumn("published_date", to_day(F.col("published"))).withColumns(
        {
            **date_parts(day),
            "days_since_published": days_since(day, as_of),
            "severity_rank": severity_rank(F.col("severity")),
            "cve_source_type": source_type(F.col("source_identifier")),
        }
    )


def transform(records: DataFrame, as_of: Column | None = None, coherent: bool = False) -> DataFrame:
    """Nested records to the cleaned columns plus ``vendor_source``. Narrow: no shuffle, no UDF."""
    return enrich(resolve_products(flatten(records, coherent)), as_of)
