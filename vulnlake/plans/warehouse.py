"""The warehouse job: star schema as tables, marts as views, and the checks that follow a load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vulnlake.functions.ids import surrogate_key
from vulnlake.operators import star
from vulnlake.operators.star import Key
from vulnlake.sources.tables import create_database, verify_count

# The marts of ``operators.marts`` as views on the loaded table.
VIEWS = {
    "monthly_overview": """SELECT year, month, count(*) AS total_cves, count_if(severity = 'HIGH') AS high_cves,
        count_if(severity = 'CRITICAL') AS critical_cves, count_if(cvss_score IS NULL) AS missing_cvss
        FROM {rows} GROUP BY year, month""",
    "severity_share": """WITH counts AS (SELECT coalesce(nullif(severity, ''), 'MISSING') AS severity, count(*) AS cve_count FROM {rows} GROUP BY 1)
        SELECT severity, cve_count, round(cve_count * 100.0D / (SELECT sum(cve_count) FROM counts), 2) AS share_pct FROM counts""",
    "data_quality": """SELECT count(*) AS total_rows, count(DISTINCT cve_id) AS distinct_cve_id,
        count(*) - count(DISTINCT cve_id) AS duplicate_cve_id, count_if(cvss_score IS NULL) AS missing_cvss,
        count_if(coalesce(vendor, '') = '') AS missing_vendor, count_if(coalesce(product, '') = '') AS missing_product FROM {rows}""",
    "vendor_counts": """SELECT vendor, count(*) AS cve_count, count(DISTINCT cve_id) AS distinct_cve_count
        FROM {rows} WHERE vendor <> '' GROUP BY vendor""",
}


def build_warehouse(spark: SparkSession, table: str, database: str, key: Key = surrogate_key) -> dict[str, int]:
    """Dimensions, facts and views over a loaded table; returns verified row counts by table.

    Every table is written once; later joins read the written dimensions, so their measured sizes decide how. Fails
    when facts and source differ in number or a fact has a key without a dimension row.
    """
    if "." not in table:
        table = f"{spark.catalog.currentDatabase()}.{table}"
    create_database(spark, database)
    rows = spark.table(table)
    facts, dims = star.build_star(rows, key)
    names = {name: f"{database}.dim_{name}" for name in dims}
    for name, dim in dims.items():
        dim.write.mode("overwrite").saveAsTable(names[name])
    names["fact"] = f"{database}.fact_cve"
    facts.write.mode("overwrite").saveAsTable(names["fact"])
    for view, text in VIEWS.items():
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{view} AS {text.format(rows=table)}")
    counts = {name: verify_count(spark, full) for name, full in names.items()}
    if counts["fact"] != verify_count(spark, table):
        raise ValueError(f"{counts['fact']} facts for {verify_count(spark, table)} rows of {table}")
    lost = orphans(spark, database)
    if lost:
        raise ValueError(f"facts without a dimension row: {lost}")
    return counts


def orphans(spark: SparkSession, database: str) -> dict[str, int]:
    """Per dimension the fact keys it lacks, dimensions without any left out."""
    facts = spark.table(f"{database}.fact_cve")
    found = {}
    for name in [*star.DIMENSIONS, "date"]:
        n = star.orphan_keys(facts, spark.table(f"{database}.dim_{name}"), f"{name}_key").count()
        if n:
            found[name] = n
    return found


def star_members(spark: SparkSession, database: str) -> DataFrame:
    """Facts by vendor, severity and year, read from the written tables."""
    dims = {name: spark.table(f"{database}.dim_{name}") for name in [*star.DIMENSIONS, "date"]}
    joined = star.star_join(spark.table(f"{database}.fact_cve"), dims)
    return joined.groupBy("vendor", "severity", "year").agg(
        F.count(F.lit(1)).alias("facts"), F.count_distinct("product").alias("products"), F.count("cvss_score").alias("scored")
    )
