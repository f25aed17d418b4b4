"""Registered queries: one per operator, over the whole driver tables.

Integers are widened, and dates and timestamps shown as text, only so that
results compare by value with the oracle engine.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vulnlake.functions import dates, ids, products, scores, sources, text, uris
from vulnlake.operators import coverage, dedupe, flatten, marts, quality, reconcile, runlog, star, windows
from vulnlake.plans import records as R
from vulnlake.plans import stored, warehouse
from vulnlake.schemas import CLEANED_COLUMNS
from vulnlake.sources import feed, tables
from vulnlake.streaming import events, routing

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}

# Parameters of the registered queries.
AS_OF = date(2002, 1, 1)
SLICE = (date(1997, 1, 1), date(1997, 6, 30))
MODIFIED = ("1998-01-01T00:00:00+00:00", "1998-04-01T00:00:00+00:00")
CHUNKS = (date(1995, 3, 1), date(2001, 3, 31), 120)
PUB_WINDOWS = windows.year_windows(date(2001, 6, 30), 5)
BASE_UNTIL = date(1999, 1, 1)
TOP = 10

ROW = ["line_no", "part_no", "supp_no"]


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__.removeprefix("q_")] = fn
    return fn


def widen(df: DataFrame) -> DataFrame:
    """All integers as bigint, dates as text."""
    kinds = {T.IntegerType: "bigint", T.DateType: "string"}
    shown = {f.name: kinds.get(type(f.dataType)) for f in df.schema.fields}
    return df.select(*[F.col(c).cast(kind).alias(c) if kind else F.col(c) for c, kind in shown.items()])


def valid_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.records(spark, sf_dir).filter(ids.is_valid_id(F.col("cve_id")))


def latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.latest_wins(valid_records(spark, sf_dir), "cve_id", F.col("last_modified"), R.ties())


def loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records as a loaded table: calendar columns, rank and age; some dates unknown."""
    df = R.records(spark, sf_dir)
    known = df.withColumn("published", F.when(F.col("order_no") % 71 != 0, F.col("published")))
    return R.dated(known).withColumns(
        {
            "severity_rank": scores.severity_rank(F.col("severity")),
            "days_since_published": dates.days_since(F.col("published_date"), F.lit(AS_OF)),
        }
    )


def nested_row() -> list[Column]:
    return [F.col(f"_{c}").cast("bigint").alias(c) for c in ROW]


# ---------------------------------------------------------------- ids, blanks, scores


@query
def q_id_filter(spark, sf_dir):
    return widen(valid_records(spark, sf_dir).select("cve_id", *ROW))


@query
def q_blank_counts(spark, sf_dir):
    return quality.missing_counts(R.records(spark, sf_dir), ["vendor", "product", "severity", "cvss_score"])


@query
def q_score_validity(spark, sf_dir):
    case = F.col("order_no") % 13
    odd = ["abc", "-0.1", "10.1", " ", "true", "NaN", None, "1e1"]
    value = F.col("cvss_score").cast("string")
    for i, item in enumerate(odd):
        value = F.when(case == i, F.lit(item)).otherwise(value)
    df = R.records(spark, sf_dir).select(case.alias("case_no"), value.alias("score"))
    return df.groupBy("case_no", scores.is_valid_score(F.col("score")).alias("valid")).agg(
        F.count(F.lit(1)).alias("records")
    )


@query
def q_severity_rank(spark, sf_dir):
    rank = scores.severity_rank(F.col("severity")).cast("bigint")
    return R.records(spark, sf_dir).groupBy("severity", rank.alias("severity_rank")).agg(F.count(F.lit(1)).alias("records"))


@query
def q_null_markers(spark, sf_dir):
    case = F.col("order_no") % 7
    value = F.col("vendor")
    for i, item in enumerate(["NULL", " null ", "NaN", "", " x ", "Null"]):
        value = F.when(case == i, F.lit(item)).otherwise(value)
    df = R.records(spark, sf_dir).select(case.alias("case_no"), text.null_markers(value).alias("value"))
    return df.groupBy("case_no", "value").agg(F.count(F.lit(1)).alias("records"))


# ---------------------------------------------------------------- dedupe and quality


@query
def q_latest_wins(spark, sf_dir):
    newest = latest(spark, sf_dir)
    return widen(newest.select("cve_id", F.to_date("last_modified").alias("last_modified"), *ROW, "price"))


@query
def q_duplicate_ids(spark, sf_dir):
    return dedupe.duplicate_ids(R.records(spark, sf_dir), "cve_id")


@query
def q_quality_counts(spark, sf_dir):
    df = R.records(spark, sf_dir).withColumn("description_en", F.col("product"))
    return quality.long_form(quality.run_counts(df, F.col("last_modified"), R.ties()))


@query
def q_severity_buckets(spark, sf_dir):
    return quality.severity_buckets(latest(spark, sf_dir))


@query
def q_source_types(spark, sf_dir):
    df = latest(spark, sf_dir).withColumn("cve_source_type", sources.source_type(F.col("source_identifier")))
    return quality.source_types(df)


# Identifiers with every rule and its edge.
IDENTIFIERS = [
    None, "", "   ", "secure@microsoft.com", "  SECURE@Microsoft.COM ", "github.com", "cna@vuldb.com",
    "a@b@snyk.io", "ICS-CERT@hq.dhs.gov", "concert@acme.com", "desk@agency.gov.uk", "x@mod.mil",
    "x@ssi.gouv.fr", "team@ipa.go.jp", "x@wiz.io", "x@notwiz.io", "cve@mitre.org", "x@sub.apache.org",
    "x@apache.org", "nobody",
]


@query
def q_source_classes(spark, sf_dir):
    options = F.array(*[F.lit(i) for i in IDENTIFIERS])
    case = F.pmod("order_no", F.lit(len(IDENTIFIERS)))
    df = R.records(spark, sf_dir).select(
        case.alias("case_no"), F.element_at(options, (case + 1).cast("int")).alias("source_identifier")
    )
    return df.groupBy("case_no", sources.source_type(F.col("source_identifier")).alias("cve_source_type")).agg(
        F.count(F.lit(1)).alias("records")
    )


@query
def q_date_range(spark, sf_dir):
    df = quality.date_range(loaded(spark, sf_dir))
    pattern = "yyyy-MM-dd HH:mm:ss"
    return widen(df.withColumns({c: F.date_format(c, pattern) for c in ("min_published", "max_published")}))


@query
def q_date_parts(spark, sf_dir):
    broken = F.when(F.col("order_no") % 31 == 0, F.lit("not a date")).otherwise(R.iso(F.col("published")))
    day = F.col("published_date")
    df = R.records(spark, sf_dir).withColumn("published_date", dates.to_day(broken))
    df = df.withColumns({**dates.date_parts(day), "days_since_published": dates.days_since(day, F.lit(AS_OF))})
    return widen(df.select("cve_id", *ROW, "published_date", "year", "month", "quarter", "days_since_published"))


@query
def q_load_types(spark, sf_dir):
    case, stamp = F.col("order_no") % 4, R.iso(F.col("published"))
    value = (
        F.when(case == 0, stamp)
        .when(case == 1, F.concat(stamp, F.lit("Z")))
        .when(case == 2, F.concat(stamp, F.lit("+02:00")))
        .otherwise(F.lit("soon"))
    )
    shown = F.date_format(dates.to_ntz(value), "yyyy-MM-dd HH:mm:ss")
    return widen(R.records(spark, sf_dir).select("cve_id", *ROW, shown.alias("published_ntz")))


# ---------------------------------------------------------------- marts and checks


@query
def q_load_dups(spark, sf_dir):
    return marts.load_dups(R.records(spark, sf_dir))


@query
def q_monthly_overview(spark, sf_dir):
    return widen(marts.monthly_overview(loaded(spark, sf_dir)))


@query
def q_severity_share(spark, sf_dir):
    return marts.severity_share(R.records(spark, sf_dir))


@query
def q_data_quality(spark, sf_dir):
    return marts.data_quality(R.records(spark, sf_dir))


@query
def q_vendor_counts(spark, sf_dir):
    return marts.vendor_counts(R.records(spark, sf_dir))


@query
def q_top_vendors(spark, sf_dir):
    return marts.top_vendors(R.records(spark, sf_dir), TOP)


@query
def q_version_counts(spark, sf_dir):
    return marts.version_counts(R.records(spark, sf_dir))


# ---------------------------------------------------------------- windows


@query
def q_window_slice(spark, sf_dir):
    return windows.slice_window(R.raw_nested(spark, sf_dir), *SLICE).select("id", *nested_row())


@query
def q_window_envelope(spark, sf_dir):
    return windows.slice_envelope(windows.slice_window(R.raw_nested(spark, sf_dir), *SLICE))


@query
def q_modified_slice(spark, sf_dir):
    since, until = (F.lit(t).cast("timestamp") for t in MODIFIED)
    return windows.slice_modified(R.raw_nested(spark, sf_dir), since, until).select("id", *nested_row())


@query
def q_chunk_coverage(spark, sf_dir):
    return widen(windows.chunk_coverage(loaded(spark, sf_dir), "published_date", *CHUNKS))


@query
def q_pub_windows(spark, sf_dir):
    return windows.pub_windows(loaded(spark, sf_dir), PUB_WINDOWS)


@query
def q_window_breakdown(spark, sf_dir):
    order = [F.col("last_modified"), *R.ties()]
    return windows.window_breakdown(loaded(spark, sf_dir), PUB_WINDOWS, order)


@query
def q_first_per_window(spark, sf_dir):
    df = loaded(spark, sf_dir).withColumn("window", windows.assign_window(F.col("published_date"), PUB_WINDOWS))
    df = df.filter(F.col("window") != windows.OUTSIDE).select("window", "cve_id", "last_modified", *R.TIES)
    first = dedupe.first_per(df, ["window", "cve_id"], [F.col("last_modified"), *R.ties()])
    return widen(first.select("window", "cve_id", *ROW))


# ---------------------------------------------------------------- star schema


@query
def q_dim_vendor(spark, sf_dir):
    return star.dim_from(R.records(spark, sf_dir), "vendor", key=ids.portable_key)


@query
def q_dim_product(spark, sf_dir):
    return star.dim_from(R.records(spark, sf_dir), "product", key=ids.portable_key)


@query
def q_dim_severity(spark, sf_dir):
    return star.dim_from(R.records(spark, sf_dir), "severity", key=ids.portable_key)


@query
def q_dim_date(spark, sf_dir):
    return widen(star.dim_date(loaded(spark, sf_dir), key=ids.portable_key))


@query
def q_star_fact(spark, sf_dir):
    return widen(star.fact(loaded(spark, sf_dir), key=ids.portable_key))


@query
def q_star_join(spark, sf_dir):
    joined = star.star_join(*star.build_star(loaded(spark, sf_dir), key=ids.portable_key))
    return joined.groupBy("vendor", "severity", "year").agg(
        F.count(F.lit(1)).alias("facts"),
        F.count_distinct("product").alias("products"),
        F.count("cvss_score").alias("scored"),
    ).withColumn("year", F.col("year").cast("bigint"))


@query
def q_star_orphans(spark, sf_dir):
    """Dimensions built before some members existed: exactly the missing members' keys are orphans."""
    df = loaded(spark, sf_dir)
    missing = {
        "vendor": F.col("vendor").isin("Brand#13", "Brand#5", "Brand#7"),
        "product": (F.col("product") != "") & (F.col("product") < "m"),
        "severity": F.col("severity") == "CRITICAL",
        "date": F.col("published_date") >= F.lit(date(2001, 1, 1)),
    }
    facts = star.fact(df, ids.portable_key)
    found = None
    for name, late in missing.items():
        early = df.filter(~F.coalesce(late, F.lit(False)))
        dim = star.dim_date(early, ids.portable_key) if name == "date" else star.dim_from(early, name, key=ids.portable_key)
        orphans = star.orphan_keys(facts, dim, f"{name}_key").select(F.lit(name).alias("dimension"), F.col(f"{name}_key").alias("orphan_key"))
        found = orphans if found is None else found.unionByName(orphans)
    return found


def from_warehouse(spark: SparkSession, sf_dir: str, answer: Callable[[str], DataFrame]) -> DataFrame:
    """An answer of the warehouse over a loaded catalog table, built in a database of its own, which is dropped again."""
    name = f"star_{uuid.uuid4().hex}"
    tables.create_database(spark, name)
    try:
        loaded(spark, sf_dir).write.saveAsTable(f"{name}.cleaned")
        warehouse.build_warehouse(spark, f"{name}.cleaned", name, ids.portable_key)
        out = answer(name)
        folder = stored.work(spark, "warehouse")
        out.write.parquet(folder)
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")
    return spark.read.schema(out.schema).parquet(folder)


@query
def q_star_tables(spark, sf_dir):
    """The written star, joined: the same figures as from the lazy one."""
    return from_warehouse(spark, sf_dir, lambda name: warehouse.star_members(spark, name).withColumn("year", F.col("year").cast("bigint")))


@query
def q_load_verify(spark, sf_dir):
    """Figures of the written tables and views."""

    def figures(name: str) -> DataFrame:
        counts = spark.sql(f"""SELECT (SELECT count(*) FROM {name}.fact_cve) AS facts, (SELECT count(*) FROM {name}.dim_vendor) AS vendors,
            (SELECT count(*) FROM {name}.dim_product) AS products, (SELECT count(*) FROM {name}.dim_severity) AS severities,
            (SELECT count(*) FROM {name}.dim_date) AS dates, (SELECT count(*) FROM {name}.monthly_overview) AS months,
            (SELECT sum(cve_count) FROM {name}.severity_share) AS shared, (SELECT sum(cve_count) FROM {name}.vendor_counts) AS named,
            (SELECT duplicate_cve_id FROM {name}.data_quality) AS duplicates""")
        return quality.long_form(counts)

    return from_warehouse(spark, sf_dir, figures)


# ---------------------------------------------------------------- loading


@query
def q_schema_align(spark, sf_dir):
    df = R.records(spark, sf_dir).select(
        F.col("vendor").alias("VENDOR"), F.col("cvss_score").alias("Cvss_Score"), F.col("cve_id").alias("cve_ID"), "price"
    )
    target = T.StructType().add("cve_id", "string").add("vendor", "string").add("cvss_score", "double").add("affected_status", "string")
    return tables.align_to_schema(df, target, strict=False)


@query
def q_load_append_dups(spark, sf_dir):
    df = latest(spark, sf_dir).select("cve_id", "vendor")
    again = df.filter(F.col("vendor") == "Brand#5").select("cve_id")
    return marts.load_dups(tables.append_by_name(df, again))


@query
def q_load_reconcile(spark, sf_dir):
    """The report of the kept rows against the table after those rows and all others were appended."""
    kept = latest(spark, sf_dir)
    counts = [
        F.count(F.lit(1)).alias("output_records"),
        F.count_if(F.col("cvss_score").isNull()).alias("missing_cvss"),
        F.count_if(text.is_blank(F.col("vendor"))).alias("missing_vendor"),
    ]
    report = quality.long_form(kept.agg(*counts, F.count_distinct("cve_id").alias("distinct_cve_id")))
    table = R.records(spark, sf_dir).filter(ids.is_valid_id(F.col("cve_id")))
    check = quality.long_form(
        table.agg(*counts, F.count_distinct("cve_id").alias("distinct_cve_id"), F.count("product").alias("products"))
    )
    return reconcile.reconcile(report, check)


@query
def q_row_reconcile(spark, sf_dir):
    """Rows by first and by newest version: what each side has alone.

    Rows are dealt by id once, for both sides and their comparison, over a number of parts that grows with the table.
    """
    df = valid_records(spark, sf_dir).select("cve_id", "last_modified", *R.TIES).repartition(R.parts(spark, sf_dir), "cve_id")
    first = dedupe.first_per(df, ["cve_id"], [F.col("last_modified"), *R.ties()])
    newest = dedupe.latest_wins(df, "cve_id", F.col("last_modified"), R.ties())
    columns = ["cve_id", *ROW]
    return widen(reconcile.reconcile_rows(first.select(*columns), newest.select(*columns)))


@query
def q_incremental_upsert(spark, sf_dir):
    df = valid_records(spark, sf_dir).select("cve_id", "last_modified", *R.TIES)
    version = F.col("last_modified")
    base = dedupe.latest_wins(df.filter(version < F.lit(BASE_UNTIL)), "cve_id", version, R.ties())
    increment = df.filter(F.coalesce(version >= F.lit(BASE_UNTIL), F.lit(True)))
    merged = dedupe.upsert_latest(base, increment, "cve_id", version, R.ties())
    return widen(merged.select("cve_id", F.to_date("last_modified").alias("last_modified"), *ROW))


# ---------------------------------------------------------------- nested records


@query
def q_feed_flatten(spark, sf_dir):
    nested = R.raw_nested(spark, sf_dir)
    # transform keeps only feed columns, so the row key travels in the status text.
    tagged = nested.withColumn("vulnStatus", F.concat_ws("|", "vulnStatus", "_line_no", "_part_no", "_supp_no"))
    return widen(flatten.transform(tagged, F.lit(AS_OF)).select(*CLEANED_COLUMNS))


@query
def q_batch_cleaned(spark, sf_dir):
    """The batch job's result: well-formed ids, flat and enriched, newest version per id."""
    return widen(newest_flat(spark, sf_dir).select(*CLEANED_COLUMNS))


def newest_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = R.raw_nested(spark, sf_dir).filter(ids.is_valid_id(F.col("id")))
    tagged = nested.withColumn("vulnStatus", F.concat_ws("|", *[F.lpad(F.col(f"_{c}").cast("string"), 12, "0") for c in ROW]))
    flat = flatten.transform(tagged, F.lit(AS_OF))
    return dedupe.latest_wins(flat, "cve_id", dates.to_instant(F.col("last_modified")), [F.col("vuln_status")])


@query
def q_quality_report(spark, sf_dir):
    """All figures of the batch job's report, in long form; dates as numbers."""
    nested = R.raw_nested(spark, sf_dir)
    seen = nested.agg(F.count(F.lit(1)).alias("n"), F.count_if(ids.is_valid_id(F.col("id"))).alias("valid")).first()
    report = quality.quality_report(newest_flat(spark, sf_dir), seen["n"], seen["valid"], F.lit("-"))
    groups = ["vendor_resolution", "source_type_distribution", "severity_distribution"]
    fields = [F.col(f"{n}.{f}").alias(f"{n}.{f}") for n in groups for f in report.schema[n].dataType.fieldNames()]
    days = [F.regexp_replace(d, "-", "").alias(d) for d in ("min_published_date", "max_published_date")]
    plain = [c for c in report.columns if c not in [*groups, "min_published_date", "max_published_date", "generated_at"]]
    return quality.long_form(report.select(*plain, *days, *fields))


@query
def q_first_lang_text(spark, sf_dir):
    return R.raw_nested(spark, sf_dir).select(
        "id", *nested_row(), flatten.first_lang(F.col("descriptions")).alias("description_en")
    )


@query
def q_metric_priority(spark, sf_dir):
    picked = flatten.pick_metrics(F.col("metrics"))
    return R.raw_nested(spark, sf_dir).select("id", *nested_row(), *[c.alias(n) for n, c in picked.items()])


@query
def q_metric_coherent(spark, sf_dir):
    picked = flatten.pick_metrics(F.col("metrics"), coherent=True)
    return R.raw_nested(spark, sf_dir).select("id", *nested_row(), *[c.alias(n) for n, c in picked.items()])


@query
def q_array_join_distinct(spark, sf_dir):
    return R.raw_nested(spark, sf_dir).select("id", *nested_row(), flatten.weakness_ids(F.col("weaknesses")).alias("cwe_ids"))


@query
def q_cpe_parse(spark, sf_dir):
    s, k = F.col("supp_no"), F.col("order_no")
    maker = F.concat(F.lit("maker"), (s % 10).cast("string"))
    name = (
        F.when(k % 6 == 0, F.concat(F.lit("  "), R.cpe_name(maker, F.lit("tool"), (s % 7).cast("string")), F.lit("\t")))
        .when(k % 6 == 1, R.cpe_name(maker, F.lit("*"), F.lit("-")))
        .when(k % 6 == 2, R.cpe_name(maker, F.lit("a\\:b"), F.lit("1")))
        .when(k % 6 == 3, F.lit("cpe:/a:maker:tool"))
        .when(k % 6 == 4, F.lit("cpe:2.3:a:maker"))
    )
    cpe = F.col("cpe")
    df = R.records(spark, sf_dir).withColumn("cpe", products.parse_cpe(name))
    return widen(df.select("cve_id", *ROW, *[cpe[f].alias(f) for f in ("vendor", "product", "version", "part", "cpe_uri")]))


@query
def q_cpe_first(spark, sf_dir):
    return R.raw_nested(spark, sf_dir).select("id", *nested_row(), products.first_cpe(F.col("configurations")).alias("cpe_uri"))


def resolved(spark, sf_dir):
    return flatten.resolve_products(R.raw_nested(spark, sf_dir))


@query
def q_affected_resolve(spark, sf_dir):
    return resolved(spark, sf_dir).select("id", *nested_row(), *flatten.RESOLVED_COLUMNS)


@query
def q_affected_status(spark, sf_dir):
    status = products.affected_status(products.affected_entries(F.col("affected")))
    df = R.raw_nested(spark, sf_dir).select((F.col("_part_no") % 6).alias("case_no"), status.alias("affected_status"))
    return df.groupBy("case_no", "affected_status").agg(F.count(F.lit(1)).alias("records"))


@query
def q_vendor_resolution(spark, sf_dir):
    return quality.vendor_resolution(resolved(spark, sf_dir))


@query
def q_metric_coverage(spark, sf_dir):
    return coverage.metric_coverage(R.raw_nested(spark, sf_dir), *SLICE, ties=R.nested_ties())


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record as a result page with no list, an empty list, the record, or the record twice."""
    nested = R.raw_nested(spark, sf_dir)
    record = F.struct(F.struct(*nested.columns).alias("cve"))
    k = F.col("_order_no")
    listed = (
        F.when(k % 6 == 0, F.lit(None))
        .when(k % 6 == 1, F.filter(F.array(record), lambda _: F.lit(False)))
        .when(k % 6 == 2, F.array(record, record))
        .otherwise(F.array(record))
    )
    week = F.floor(F.datediff(F.col("published").cast("date"), F.lit(date(1995, 1, 1))) / 7)
    return nested.select(week.alias("window"), (100 + week % 100).alias("totalResults"), listed.alias("vulnerabilities"))


@query
def q_page_merge(spark, sf_dir):
    return feed.merge_pages(pages(spark, sf_dir)).groupBy("id").agg(F.count(F.lit(1)).alias("records"))


@query
def q_page_audit(spark, sf_dir):
    return feed.page_audit(pages(spark, sf_dir))


# ---------------------------------------------------------------- events


def joined_errors() -> Column:
    return F.array_join("errors", "; ").alias("errors")


@query
def q_event_build(spark, sf_dir):
    return R.events_built(spark, sf_dir).drop("ts", "n")


@query
def q_contract_errors(spark, sf_dir):
    checked = events.with_errors(R.events_built(spark, sf_dir))
    return checked.select("n", (F.size("errors") == 0).alias("ok"), joined_errors())


@query
def q_event_json(spark, sf_dir):
    return events.event_json(R.events_built(spark, sf_dir))


@query
def q_event_route(spark, sf_dir):
    routed = routing.route(R.messages(spark, sf_dir))
    return widen(routed.select("partition", "offset", "kind", joined_errors()))


@query
def q_event_quarantine(spark, sf_dir):
    bad = routing.quarantine(routing.route(R.messages(spark, sf_dir)))
    return bad.groupBy("kind").agg(F.count(F.lit(1)).alias("messages"), F.count("value").alias("with_value"))


@query
def q_event_enrich(spark, sf_dir):
    stored = routing.routed_events(routing.route(R.messages(spark, sf_dir)), F.lit(R.EVENT_TIME))
    return widen(stored.select("event_id", "cvss_score", "ingested_at", "kafka_topic", "kafka_partition", "kafka_offset"))


def keyed_messages(spark, sf_dir):
    return routing.route(R.messages(spark, sf_dir)).select(F.col("_event_id").alias("event_id"), "partition", "offset", "kind", "n")


ARRIVAL = ["partition", "offset"]


@query
def q_event_batch_dedupe(spark, sf_dir):
    kept = dedupe.batch_dedupe(keyed_messages(spark, sf_dir), "event_id", [F.col(c) for c in ARRIVAL])
    return widen(kept.select("event_id", *ARRIVAL))


@query
def q_event_idempotent(spark, sf_dir):
    valid = keyed_messages(spark, sf_dir).filter(F.col("kind") == routing.VALID)
    stored = valid.filter(F.col("n") % 4 == 0)
    fresh = dedupe.insert_if_absent(valid, stored, "event_id", [F.col(c) for c in ARRIVAL])
    return widen(fresh.select("event_id", *ARRIVAL))


@query
def q_event_ledger(spark, sf_dir):
    """Ingest counts per thousand source rows; the first copy of a valid event is the one inserted."""
    routed = keyed_messages(spark, sf_dir)
    valid = F.col("kind") == routing.VALID
    # Others than valid ones are keyed by their own place, so they neither meet nor gather.
    own = F.when(valid, F.col("event_id")).otherwise(F.concat_ws("/", *ARRIVAL))
    turn = F.row_number().over(Window.partitionBy(valid, own).orderBy(*ARRIVAL))
    flagged = routed.withColumns({"stored": valid & (turn == 1), "batch": F.floor(F.col("n") / 1000)})
    return flagged.groupBy("batch").agg(*routing.ledger_counts(F.col("stored")))


@query
def q_replay_limit(spark, sf_dir):
    return events.replay_limit(R.events_built(spark, sf_dir), 50, [F.col("n")]).select("n", "event_id", "cve_id")


@query
def q_limit_consumed(spark, sf_dir):
    return widen(routing.limit_consumed(R.messages(spark, sf_dir), 40).select("partition", "offset", "n"))


@query
def q_log_summary(spark, sf_dir):
    n = F.col("event_id")
    number = n.cast("string")
    line = (
        F.when(n % 5 == 0, F.col("props"))
        .when(n % 5 == 1, F.concat(F.lit("INFO "), "props"))
        .when(n % 5 == 2, F.concat(F.lit('{"k": 1, "records": '), number, F.lit("}")))
        .when(n % 5 == 3, F.lit('{"k": 1, "records": '))
        .otherwise(F.concat(F.lit('  {"records": '), number, F.lit(', "k": 2} ')))
    )
    lines = R.table(spark, sf_dir, "events").select(n.alias("line_no"), line.alias("text"))
    return runlog.log_summary(lines, ["k", "records"])


@query
def q_uri_redact(spark, sf_dir):
    page = F.col("page_id") % 4
    uri = (
        F.when(page == 1, F.regexp_replace("url", "://", "://user:s3c@ret@"))
        .when(page == 2, F.regexp_replace("url", "^([a-z]+://[^/?#]+)", "$1:8080"))
        .when(page == 3, F.upper("url"))
        .otherwise(F.col("url"))
    )
    return R.table(spark, sf_dir, "pages").select("page_id", uris.redact_uri(uri).alias("uri"))


@query
def q_run_stats(spark, sf_dir):
    return runlog.run_stats(R.run_log(spark, sf_dir))


@query
def q_run_throughput(spark, sf_dir):
    return runlog.run_throughput(R.run_log(spark, sf_dir)).select("run_no", "throughput_per_second")


REGISTRY.update(stored.REGISTRY)
