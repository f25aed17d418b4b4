"""Vulnerability records derived from the driver tables.

``records`` is the flat form, ``raw_nested`` the same rows shaped as raw feed
records, ``event_rows`` cleaned-layer rows derived from the event table, and
``messages`` the broker messages of those. All cover the whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vulnlake.functions.ids import name_uuid4
from vulnlake.streaming.events import build_event, event_json


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of a task that ranks whole ids.
ROWS_PER_PART = 100_000


def parts(spark: SparkSession, sf_dir: str) -> int:
    """Parts to deal the records over by id: as many as the table asks for, so that a part stays as large as it is. The count comes from file footers."""
    return max(1, -(-table(spark, sf_dir, "lineitem").count() // ROWS_PER_PART))


def _when_mod(number: Column, by: int, cases: dict[int, Column], default: Column) -> Column:
    out = default
    for rest, value in cases.items():
        out = F.when(number % by == rest, value).otherwise(out)
    return out


def _null(kind: str = "string") -> Column:
    return F.lit(None).cast(kind)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items joined with their order, part and supplier, read as vulnerability records.

    Plain equi-joins: the optimizer picks broadcast or sort-merge by size, and the
    skew join splits hot keys.
    """
    line = table(spark, sf_dir, "lineitem")
    order = table(spark, sf_dir, "orders")
    part = table(spark, sf_dir, "part")
    supplier = table(spark, sf_dir, "supplier")
    joined = (
        line.join(order, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    k, p = F.col("l_orderkey"), F.col("p_partkey")
    name = k.cast("string")
    priority = F.col("o_orderpriority")
    severity = (
        F.when(priority == "1-URGENT", "CRITICAL")
        .when(priority == "2-HIGH", F.when(k % 2 == 0, "HIGH").otherwise(" high "))
        .when(priority == "3-MEDIUM", "MEDIUM")
        .when(priority == "5-LOW", "low")
        .otherwise("NOT SPECIFIED")
    )
    nation = F.col("s_nationkey")
    senders = {
        0: F.lit("secure@microsoft.com"),
        1: F.lit("cna@vuldb.com"),
        2: F.lit("ics-cert@hq.dhs.gov"),
        3: F.lit("desk@agency.gov.uk"),
    }
    return joined.select(
        F.when(k % 97 == 0, F.concat(F.lit("BAD-"), name))
        .otherwise(F.concat(F.lit("CVE-"), F.year("o_orderdate").cast("string"), F.lit("-"), name))
        .alias("cve_id"),
        F.col("o_orderdate").alias("published"),
        F.col("l_shipdate").alias("last_modified"),
        k.alias("order_no"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("part_no"),
        F.col("l_suppkey").alias("supp_no"),
        F.col("l_extendedprice").alias("price"),
        F.when(k % 19 != 0, (k % 101).cast("double") / 10).alias("cvss_score"),
        F.when(k % 19 != 0, severity).alias("severity"),
        F.when(k % 3 == 0, "3.1").when(k % 5 == 0, "2.0").when(k % 19 != 0, "4.0").alias("cvss_version"),
        F.when(p % 11 == 0, "")
        .when(p % 23 == 0, _null())
        .when(p % 29 == 0, "n/a")
        .otherwise(F.col("p_brand"))
        .alias("vendor"),
        F.when(p % 13 == 0, "").otherwise(F.col("p_name")).alias("product"),
        _when_mod(nation, 5, senders, F.lit("cve@mitre.org")).alias("source_identifier"),
    )


# Total order among versions of one record.
TIES = ["line_no", "part_no", "supp_no", "price"]


def ties() -> list[Column]:
    return [F.col(c) for c in TIES]


def dated(df: DataFrame) -> DataFrame:
    """Records with the calendar columns of the loaded table."""
    day = F.to_date("published")
    return df.withColumns(
        {"published_date": day, "year": F.year(day), "month": F.month(day), "quarter": F.quarter(day)}
    )


def iso(stamp: Column, naive: bool = True) -> Column:
    return F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss.SSS" + ("" if naive else "'+00:00'"))


def _metric(version: str, score: Column, severity: Column, vector: Column | None, beside: bool = False) -> Column:
    """One metric entry; version 2 keeps its severity beside the data."""
    vector = _null() if vector is None else vector
    data = F.struct(
        F.lit(version).alias("version"),
        score.alias("baseScore"),
        (_null() if beside else severity).alias("baseSeverity"),
        vector.alias("attackVector"),
        F.lower(vector).alias("attackComplexity"),
        F.concat(vector, F.lit("-PR")).alias("privilegesRequired"),
        F.concat(vector, F.lit("-UI")).alias("userInteraction"),
    )
    return F.struct(data.alias("cvssData"), (severity if beside else _null()).alias("baseSeverity"))


def cpe_name(vendor: Column, product: Column, version: Column) -> Column:
    head, rest = F.lit("cpe:2.3:a:"), F.lit(":*:*:*:*:*:*:*")
    return F.concat(head, vendor, F.lit(":"), product, F.lit(":"), version, rest)


def raw_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nest(records(spark, sf_dir))


def nest(r: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``records`` as raw feed records, with the awkward shapes real feeds have. ``keep`` carries further columns along.

    Every rule is keyed by remainders of the order, part and supplier numbers,
    so the expected flat values can be written down without any nesting. The
    scalar source columns are kept beside the nested ones, after an underscore.
    """
    k, p, s = F.col("order_no"), F.col("part_no"), F.col("supp_no")
    product = F.regexp_replace("product", " ", "_")

    # Descriptions: null, empty, none in English, or English second.
    foreign = F.struct(F.lit("es").alias("lang"), F.concat(F.lit("Fallo en "), "product").alias("value"))
    english = F.struct(F.lit("en").alias("lang"), F.concat(F.lit("Flaw in "), "product").alias("value"))
    second = F.struct(F.lit("en").alias("lang"), F.lit("later text").alias("value"))
    descriptions = (
        F.when(k % 7 == 0, F.lit(None))
        .when(k % 7 == 1, F.filter(F.array(english), lambda _: F.lit(False)))
        .when(k % 7 == 2, F.array(foreign))
        .otherwise(F.array(foreign, english, second))
    )

    # Metrics: any mix of blocks; 3.1 without a score when k % 15 = 0; extra entries that must be ignored.
    def score(by: int) -> Column:
        return (k % by).cast("double") / 10

    v31 = _metric("3.1", F.when(k % 15 != 0, score(101)), F.col("severity"), F.lit("NETWORK"))
    v30 = _metric("3.0", score(97), F.lit("MEDIUM"), F.lit("LOCAL"))
    v2 = _metric("2.0", score(89), F.lit("LOW"), F.lit("OLD"), beside=True)
    v40 = _metric("4.0", score(83), F.lit("HIGH"), F.lit("PHYSICAL"))
    none = F.lit(None)
    metrics = F.when(
        k % 19 != 0,
        F.struct(
            F.when(k % 3 == 0, F.array(v31, v40)).when(k % 3 == 1, F.filter(F.array(v31), lambda _: F.lit(False))).otherwise(none).alias("cvssMetricV31"),
            F.when(k % 5 == 0, F.array(v30)).otherwise(none).alias("cvssMetricV30"),
            F.when(k % 4 == 0, F.array(v2, v2)).otherwise(none).alias("cvssMetricV2"),
            F.when(k % 2 == 0, F.array(v40)).otherwise(none).alias("cvssMetricV40"),
        ),
    )

    # Weaknesses: null, an entry without descriptions, repeats and blanks.
    def weakness(*values: Column) -> Column:
        items = F.array(*[F.struct(v.alias("value")) for v in values])
        return F.struct(items.alias("description"))

    bare = F.struct(F.when(k < 0, F.array(F.struct(F.lit("").alias("value")))).alias("description"))
    cwe = F.concat(F.lit("CWE-"), (p % 40).cast("string"))
    weaknesses = (
        F.when(k % 5 == 0, F.lit(None))
        .when(k % 5 == 1, F.array(bare))
        .when(k % 5 == 2, F.array(weakness(cwe), bare, weakness(F.lit(""), F.lit("CWE-79"))))
        .when(k % 5 == 3, F.array(weakness(F.lit("CWE-79"), cwe), weakness(cwe, F.lit(" "))))
        .otherwise(F.array(weakness(cwe)))
    )

    # Affected entries: null, list without data, placeholder first, product only, or the record's own vendor.
    def entry(vendor: Column, prod: Column, status: Column, versions: list[Column], cpes: list[Column]) -> Column:
        return F.struct(
            vendor.alias("vendor"),
            prod.alias("product"),
            status.alias("defaultStatus"),
            F.array(*[F.struct(v.alias("version"), F.lit("affected").alias("status")) for v in versions]).alias("versions"),
            F.array(*cpes).alias("cpes"),
        )

    def source(*entries: Column) -> Column:
        return F.struct(F.lit("feed").alias("source"), F.array(*entries).alias("affectedData"))

    own = entry(
        F.concat(F.lit(" "), "vendor"), F.col("product"), F.lit("affected"),
        [F.lit(" "), F.concat(F.lit("< "), (s % 9).cast("string"))], [F.lit(""), F.lit(" cpe:/a:own ")],
    )
    holder = entry(F.lit("N/A"), F.lit("-"), F.lit("unaffected"), [F.lit("1")], [F.lit("cpe:/a:holder")])
    only_product = entry(F.lit("Unknown"), F.lit("Shared Files"), F.lit("unknown"), [F.lit("2")], [F.lit(" ")])
    bare_source = F.struct(
        F.lit("feed").alias("source"), F.when(k < 0, F.array(own)).alias("affectedData")
    )
    affected = (
        F.when(p % 6 == 0, F.lit(None))
        .when(p % 6 == 1, F.array(bare_source))
        .when(p % 6 == 2, F.array(source(only_product)))
        .when(p % 6 == 3, F.array(bare_source, source(holder, own)))
        .when(p % 6 == 4, F.array(source(holder), source(only_product, own)))
        .otherwise(F.array(source(own)))
    )

    # Configurations: null, nodes missing, an older name first, a wildcard product, an escaped colon.
    def node(*criteria: Column) -> Column:
        return F.struct(F.array(*[F.struct(c.alias("criteria")) for c in criteria]).alias("cpeMatch"))

    def config(*nodes: Column) -> Column:
        return F.struct(F.array(*nodes).alias("nodes"))

    maker = F.concat(F.lit("maker"), (s % 10).cast("string"))
    good = cpe_name(maker, F.coalesce(F.nullif(product, F.lit("")), F.lit("*")), (s % 7).cast("string"))
    wild = cpe_name(maker, F.lit("*"), F.lit("-"))
    escaped = cpe_name(maker, F.lit("a\\:b"), F.lit("1"))
    bare_node = F.struct(F.when(k < 0, F.array(F.struct(F.lit("").alias("criteria")))).alias("cpeMatch"))
    bare_config = F.struct(F.when(k < 0, F.array(bare_node)).alias("nodes"))
    configurations = (
        F.when(s % 5 == 0, F.lit(None))
        .when(s % 5 == 1, F.array(bare_config, config(bare_node, node(F.lit("cpe:/a:old"), F.concat(F.lit(" "), good)))))
        .when(s % 5 == 2, F.array(config(node(wild, good))))
        .when(s % 5 == 3, F.array(config(node(escaped))))
        .otherwise(F.array(config(bare_node, node(F.lit("cpe:/a:old"))), config(node(good))))
    )

    status = _when_mod(F.col("line_no"), 3, {0: F.lit("Analyzed"), 1: F.lit("Modified")}, F.lit("Rejected"))
    return r.select(
        F.col("cve_id").alias("id"),
        iso(F.col("published")).alias("published"),
        iso(F.col("last_modified")).alias("lastModified"),
        status.alias("vulnStatus"),
        F.col("source_identifier").alias("sourceIdentifier"),
        descriptions.alias("descriptions"),
        metrics.alias("metrics"),
        weaknesses.alias("weaknesses"),
        affected.alias("affected"),
        configurations.alias("configurations"),
        *[F.col(c).alias(f"_{c}") for c in ["order_no", *TIES]],
        *(keep or []),
    )


def nested_ties() -> list[Column]:
    return [F.col(f"_{c}") for c in TIES]


# ---------------------------------------------------------------- events

EVENT_TIME = "2024-02-01T00:00:00.000000+00:00"


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table read as cleaned-layer rows, a share of them broken in different ways."""
    # A file of few row groups is read by few tasks; its rows are dealt to all before anything is built from them.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    e = table(spark, sf_dir, "events").repartition(parts)
    n = F.col("event_id")
    number = n.cast("string")
    stamp = iso(F.col("ts"))
    kinds = {"error": "critical", "signup": " High ", "purchase": "LOW", "click": ""}
    severity = F.lit("Medium")
    for kind, text in kinds.items():
        severity = F.when(F.col("event_type") == kind, F.lit(text)).otherwise(severity)
    return e.select(
        n.alias("n"),
        F.when(n % 37 == 0, F.concat(F.lit("CVE-24-"), number))
        .otherwise(F.concat(F.lit("CVE-2024-"), number))
        .alias("cve_id"),
        F.when(n % 41 == 0, F.lit("yesterday"))
        .when(n % 5 == 0, F.concat(stamp, F.lit("Z")))
        .otherwise(stamp)
        .alias("published"),
        F.when(n % 43 == 0, F.lit(" ")).otherwise(stamp).alias("last_modified"),
        F.when(n % 11 == 0, F.lit("N/A"))
        .when(n % 13 == 0, F.lit(" "))
        .when(n % 17 == 0, F.lit("11.5"))
        .otherwise(((n % 101).cast("double") / 10).cast("string"))
        .alias("cvss_score"),
        F.when(n % 47 == 0, F.lit("MEGA")).otherwise(severity).alias("severity"),
        F.when(n % 6 == 0, F.lit("  ")).otherwise(F.concat(F.lit("vendor"), (F.col("user_id") % 50).cast("string"))).alias("vendor"),
        F.when(n % 7 != 0, F.col("event_type")).alias("product"),
        F.when(n % 53 == 0, F.lit("")).otherwise(F.concat(F.lit("Event with props "), "props")).alias("description_en"),
        F.when(n % 4 == 0, F.lit("cpe:2.3:a:x:y:1:*:*:*:*:*:*:*")).alias("cpe_uri"),
        F.col("ts"),
    )


def events_built(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ids derived from the row number, so results repeat. Some ids are no UUID4."""
    rows = event_rows(spark, sf_dir)
    name = F.col("n").cast("string")
    bad_version = F.regexp_replace(name_uuid4(name), "-4", "-1")
    event_id = (
        F.when(F.col("n") % 59 == 0, F.lit("no-uuid"))
        .when(F.col("n") % 61 == 0, bad_version)
        .otherwise(name_uuid4(name))
    )
    return build_event(rows, event_id, F.lit(EVENT_TIME), keep=["n", "ts"])


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broker messages of the events: a share is no JSON or no object, and a third is sent again later."""
    n = F.col("n")
    sent = event_json(events_built(spark, sf_dir), keep=["n"])
    value = (
        F.when(n % 23 == 0, F.lit("not-json"))
        .when(n % 23 == 1, F.lit("[1]"))
        .when(n % 23 == 2, F.lit("3"))
        .when(n % 23 == 3, F.lit("null"))
        .when(n % 23 == 4, F.lit('{"event_id": "only"}'))
        .when(n % 23 == 5, _null())
        .otherwise(F.col("value"))
    )
    # The copy of a message carries the odd offset after its original, on another partition for some.
    place = lambda partition, offset: F.struct(partition.cast("int").alias("partition"), offset.alias("offset"))
    first, again = place(n % 4, n * 2), place(F.when(n % 2 == 0, n % 4).otherwise(F.lit(0)), n * 2 + 1)
    places = F.when(n % 3 == 0, F.array(first, again)).otherwise(F.array(first))
    return sent.select(F.lit("events").alias("topic"), value.alias("value"), "n", F.inline(places)).select("topic", "partition", "offset", "value", "n")


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders read as timed runs, some without duration or records."""
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        k.alias("run_no"),
        F.col("o_orderpriority").alias("label"),
        F.when(k % 31 == 0, F.lit(0.0)).when(k % 29 == 0, _null("double")).otherwise(F.col("o_totalprice")).alias("duration_s"),
        F.when(k % 37 == 0, _null("bigint")).when(k % 41 == 0, F.lit(0)).otherwise(F.col("o_custkey")).alias("records"),
    )
