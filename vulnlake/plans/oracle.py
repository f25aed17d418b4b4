"""Expected results as SQL over the same tables, written from the rules, not from the Spark code.

Nested inputs never appear here: every case of a nested column is a remainder
of the order, part or supplier number, so its flat value is a CASE.
"""

from __future__ import annotations

RECORDS = """records AS (
SELECT
  CASE WHEN l.l_orderkey % 97 = 0 THEN concat('BAD-', cast(l.l_orderkey AS varchar))
       ELSE concat('CVE-', cast(year(o.o_orderdate) AS varchar), '-', cast(l.l_orderkey AS varchar)) END AS cve_id,
  o.o_orderdate AS published, l.l_shipdate AS last_modified, l.l_orderkey AS order_no,
  cast(l.l_linenumber AS bigint) AS line_no, l.l_partkey AS part_no, l.l_suppkey AS supp_no, l.l_extendedprice AS price,
  CASE WHEN l.l_orderkey % 19 = 0 THEN NULL ELSE cast(l.l_orderkey % 101 AS double) / 10 END AS cvss_score,
  CASE WHEN l.l_orderkey % 19 = 0 THEN NULL
       ELSE CASE o.o_orderpriority WHEN '1-URGENT' THEN 'CRITICAL'
            WHEN '2-HIGH' THEN CASE WHEN l.l_orderkey % 2 = 0 THEN 'HIGH' ELSE ' high ' END
            WHEN '3-MEDIUM' THEN 'MEDIUM' WHEN '5-LOW' THEN 'low' ELSE 'NOT SPECIFIED' END END AS severity,
  CASE WHEN l.l_orderkey % 3 = 0 THEN '3.1' WHEN l.l_orderkey % 5 = 0 THEN '2.0'
       WHEN l.l_orderkey % 19 = 0 THEN NULL ELSE '4.0' END AS cvss_version,
  CASE WHEN p.p_partkey % 11 = 0 THEN '' WHEN p.p_partkey % 23 = 0 THEN NULL
       WHEN p.p_partkey % 29 = 0 THEN 'n/a' ELSE p.p_brand END AS vendor,
  CASE WHEN p.p_partkey % 13 = 0 THEN '' ELSE p.p_name END AS product,
  CASE s.s_nationkey % 5 WHEN 0 THEN 'secure@microsoft.com' WHEN 1 THEN 'cna@vuldb.com'
       WHEN 2 THEN 'ics-cert@hq.dhs.gov' WHEN 3 THEN 'desk@agency.gov.uk' ELSE 'cve@mitre.org' END AS source_identifier
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN part p ON l.l_partkey = p.p_partkey JOIN supplier s ON l.l_suppkey = s.s_suppkey)"""

VALID = """valid AS (SELECT * FROM records WHERE regexp_full_match(cve_id, 'CVE-[0-9]{4}-[0-9]+'))"""

NEWEST = "last_modified DESC NULLS LAST, line_no DESC, part_no DESC, supp_no DESC, price DESC"
OLDEST = "last_modified, line_no, part_no, supp_no, price"

LATEST = f"""latest AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY cve_id ORDER BY {NEWEST}) AS rn FROM valid) WHERE rn = 1)"""

SEVERITY = "upper(trim(severity))"
RANK = f"""CASE {SEVERITY} WHEN 'NONE' THEN 0 WHEN 'LOW' THEN 1 WHEN 'MEDIUM' THEN 2
  WHEN 'HIGH' THEN 3 WHEN 'CRITICAL' THEN 4 END"""

LOADED = f"""loaded AS (
SELECT *, cast(published AS date) AS published_date, cast(year(published) AS bigint) AS year,
  cast(month(published) AS bigint) AS month, cast(quarter(published) AS bigint) AS quarter,
  cast({RANK} AS bigint) AS severity_rank,
  cast(date_diff('day', cast(published AS date), DATE '2002-01-01') AS bigint) AS days_since_published
FROM (SELECT * REPLACE (CASE WHEN order_no % 71 = 0 THEN NULL ELSE published END AS published) FROM records))"""

SOURCE_TYPE = """CASE source_identifier WHEN 'secure@microsoft.com' THEN 'vendor_direct' WHEN 'cna@vuldb.com' THEN 'third_party_db'
  WHEN 'ics-cert@hq.dhs.gov' THEN 'cert_national' WHEN 'desk@agency.gov.uk' THEN 'cert_national' ELSE 'other' END"""

# Flat expectation of the nested records, one step per CTE.
NESTED = f"""steps AS (
SELECT *, order_no AS k, part_no AS p, supp_no AS s,
  order_no % 19 <> 0 AND order_no % 3 = 0 AS has31, order_no % 19 <> 0 AND order_no % 5 = 0 AS has30,
  order_no % 19 <> 0 AND order_no % 4 = 0 AS has2, order_no % 19 <> 0 AND order_no % 2 = 0 AS has40,
  CASE WHEN trim(coalesce(vendor, '')) IN ('', 'n/a') THEN '' ELSE vendor END AS v,
  replace(product, ' ', '_') AS prod_, concat('maker', cast(supp_no % 10 AS varchar)) AS maker,
  concat('CWE-', cast(part_no % 40 AS varchar)) AS cwe
FROM records),
picked AS (
SELECT *,
  CASE WHEN has31 THEN 'NETWORK' WHEN has30 THEN 'LOCAL' WHEN has40 THEN 'PHYSICAL' END AS vector,
  CASE WHEN p % 6 IN (0, 1) THEN 'none' WHEN p % 6 = 2 THEN 'prod'
       WHEN v <> '' THEN 'own' WHEN p % 6 = 4 THEN 'prod' WHEN product <> '' THEN 'own' ELSE 'none' END AS sel,
  concat('cpe:2.3:a:', maker, ':', coalesce(nullif(prod_, ''), '*'), ':', cast(s % 7 AS varchar), ':*:*:*:*:*:*:*') AS good
FROM steps),
parsed AS (
SELECT *,
  CASE s % 5 WHEN 1 THEN good WHEN 2 THEN concat('cpe:2.3:a:', maker, ':*:-:*:*:*:*:*:*:*')
       WHEN 3 THEN concat('cpe:2.3:a:', maker, ':a\\:b:1:*:*:*:*:*:*:*') WHEN 4 THEN good END AS uri,
  CASE WHEN s % 5 IN (1, 2, 4) THEN maker ELSE '' END AS cpe_vendor,
  CASE WHEN s % 5 IN (1, 4) THEN prod_ ELSE '' END AS cpe_product,
  CASE sel WHEN 'own' THEN v ELSE '' END AS own_vendor,
  CASE sel WHEN 'own' THEN product WHEN 'prod' THEN 'Shared Files' ELSE '' END AS own_product
FROM picked),
flat AS (
SELECT cve_id AS id, order_no, line_no, part_no, supp_no, price, source_identifier, published AS published_ts, last_modified AS modified_ts,
  strftime(published, '%Y-%m-%dT%H:%M:%S.%g') AS published, strftime(last_modified, '%Y-%m-%dT%H:%M:%S.%g') AS last_modified,
  CASE line_no % 3 WHEN 0 THEN 'Analyzed' WHEN 1 THEN 'Modified' ELSE 'Rejected' END AS vuln_status,
  CASE WHEN k % 7 > 2 THEN concat('Flaw in ', product) END AS description_en,
  CASE WHEN has31 THEN '3.1' WHEN has30 THEN '3.0' WHEN has2 THEN '2.0' WHEN has40 THEN '4.0' END AS cvss_version,
  CASE WHEN has31 AND k % 15 <> 0 THEN cast(k % 101 AS double) / 10 WHEN has30 THEN cast(k % 97 AS double) / 10
       WHEN has2 THEN cast(k % 89 AS double) / 10 WHEN has40 THEN cast(k % 83 AS double) / 10 END AS cvss_score,
  CASE WHEN has31 THEN severity WHEN has30 THEN 'MEDIUM' WHEN has2 THEN 'LOW' WHEN has40 THEN 'HIGH' END AS severity,
  vector AS attack_vector, lower(vector) AS attack_complexity, vector || '-PR' AS privileges_required, vector || '-UI' AS user_interaction,
  CASE k % 5 WHEN 2 THEN cwe || ',CWE-79' WHEN 3 THEN 'CWE-79,' || cwe WHEN 4 THEN cwe ELSE '' END AS cwe_ids,
  coalesce(nullif(own_vendor, ''), cpe_vendor) AS vendor, coalesce(nullif(own_product, ''), cpe_product) AS product,
  CASE WHEN sel = 'own' THEN 'cpe:/a:own' ELSE coalesce(uri, '') END AS cpe_uri, uri,
  CASE WHEN p % 6 > 2 THEN 'affected' ELSE '' END AS affected_status,
  CASE sel WHEN 'own' THEN concat('< ', cast(s % 9 AS varchar)) WHEN 'prod' THEN '2' ELSE '' END AS affected_version_range,
  CASE WHEN own_vendor <> '' THEN 'affected' WHEN cpe_vendor <> '' THEN 'cpe_fallback' ELSE 'unresolved' END AS vendor_source,
  has31, has30, has2, has40, k, vector, severity AS own_severity
FROM parsed)"""

CLEANED = f"""cve_id, published, cast(cast(published_ts AS date) AS varchar) AS published_date, cast(year(published_ts) AS bigint) AS year,
  cast(month(published_ts) AS bigint) AS month, cast(quarter(published_ts) AS bigint) AS quarter,
  cast(date_diff('day', cast(published_ts AS date), DATE '2002-01-01') AS bigint) AS days_since_published,
  last_modified, vuln_status, description_en, cvss_version, cvss_score, severity, cast({RANK} AS bigint) AS severity_rank,
  attack_vector, attack_complexity, privileges_required, user_interaction, cwe_ids, vendor, product, cpe_uri,
  source_identifier, {SOURCE_TYPE} AS cve_source_type, affected_status, affected_version_range"""


def _uuid(text: str) -> str:
    h = f"md5({text})"
    return (
        f"concat(substr({h}, 1, 8), '-', substr({h}, 9, 4), '-4', substr({h}, 14, 3), '-8', substr({h}, 18, 3), '-', substr({h}, 21, 12))"
    )


def _key(expression: str) -> str:
    return f"cast('0x' || substr(md5(coalesce(cast({expression} AS varchar), '')), 1, 15) AS bigint)"


NOW = "2024-02-01T00:00:00.000000+00:00"

EVENTS = f"""built AS (
SELECT event_id AS n,
  CASE WHEN event_id % 59 = 0 THEN 'no-uuid'
       WHEN event_id % 61 = 0 THEN regexp_replace({_uuid('cast(event_id AS varchar)')}, '-4', '-1', 'g')
       ELSE {_uuid('cast(event_id AS varchar)')} END AS event_id,
  '{NOW}' AS event_timestamp, 'cve_published' AS event_type, 'nvd_replay' AS source,
  CASE WHEN event_id % 37 = 0 THEN concat('CVE-24-', cast(event_id AS varchar)) ELSE concat('CVE-2024-', cast(event_id AS varchar)) END AS cve_id,
  CASE WHEN event_id % 41 = 0 THEN 'yesterday' WHEN event_id % 5 = 0 THEN stamp || 'Z' ELSE stamp || '+00:00' END AS published,
  CASE WHEN event_id % 43 = 0 THEN ' ' ELSE stamp || '+00:00' END AS last_modified,
  CASE WHEN event_id % 11 = 0 OR event_id % 13 = 0 THEN NULL WHEN event_id % 17 = 0 THEN 11.5
       ELSE cast(event_id % 101 AS double) / 10 END::double AS cvss_score,
  CASE WHEN event_id % 47 = 0 THEN 'MEGA' ELSE CASE event_type WHEN 'error' THEN 'CRITICAL' WHEN 'signup' THEN 'HIGH'
       WHEN 'purchase' THEN 'LOW' WHEN 'click' THEN NULL ELSE 'MEDIUM' END END AS severity,
  CASE WHEN event_id % 6 <> 0 THEN concat('vendor', cast(user_id % 50 AS varchar)) END AS vendor,
  CASE WHEN event_id % 7 <> 0 THEN e.event_type END AS product,
  CASE WHEN event_id % 53 = 0 THEN '' ELSE concat('Event with props ', props) END AS description,
  CASE WHEN event_id % 4 = 0 THEN 'cpe:2.3:a:x:y:1:*:*:*:*:*:*:*' END AS raw_cpe_uri
FROM (SELECT *, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') AS stamp FROM events) e)"""

EVENT_COLUMNS = """event_id, event_timestamp, event_type, source, cve_id, published, last_modified, cvss_score, severity,
  vendor, product, description, raw_cpe_uri"""

CHECKED = """checked AS (
SELECT *, concat_ws('; ',
  CASE WHEN n % 43 = 0 THEN 'missing or empty required field: last_modified' END,
  CASE WHEN n % 53 = 0 THEN 'missing or empty required field: description' END,
  CASE WHEN n % 37 = 0 THEN concat('malformed cve_id: ''', cve_id, '''') END,
  CASE WHEN n % 59 = 0 THEN 'event_id is not a valid UUID: ''no-uuid'''
       WHEN n % 61 = 0 THEN concat('event_id is not a UUID4: ''', event_id, '''') END,
  CASE WHEN n % 41 = 0 THEN 'published is not ISO-8601 (with UTC offset): ''yesterday''' END,
  CASE WHEN cvss_score > 10 THEN 'cvss_score out of range 0..10: 11.5' END,
  CASE WHEN n % 47 = 0 THEN 'severity not in [''CRITICAL'', ''HIGH'', ''LOW'', ''MEDIUM'', ''NONE'']: ''MEGA''' END) AS errors
FROM built)"""

ONLY_ID = "; ".join(
    [
        f"missing or empty required field: {f}"
        for f in ("event_timestamp", "event_type", "source", "cve_id", "published", "last_modified", "description")
    ]
    + [
        "event_type must be ''cve_published'', got None",
        "source must be ''nvd_replay'', got None",
        "event_id is not a valid UUID: ''only''",
    ]
)

ROUTED = f"""first_copy AS (
SELECT n, cast(n % 4 AS bigint) AS "partition", n * 2 AS "offset",
  CASE WHEN n % 23 IN (0, 3, 5) THEN 'not_json' WHEN n % 23 IN (1, 2) THEN 'not_object' WHEN n % 23 = 4 THEN 'invalid'
       WHEN errors <> '' THEN 'invalid' ELSE 'valid' END AS kind,
  CASE WHEN n % 23 IN (0, 3, 5) THEN '' WHEN n % 23 IN (1, 2) THEN 'event must be a dict'
       WHEN n % 23 = 4 THEN '{ONLY_ID}' ELSE errors END AS errors,
  CASE WHEN n % 23 < 4 OR n % 23 = 5 THEN NULL WHEN n % 23 = 4 THEN 'only' ELSE event_id END AS event_id,
  cvss_score
FROM checked),
routed AS (
SELECT * FROM first_copy
UNION ALL
SELECT n, CASE WHEN n % 2 = 0 THEN "partition" ELSE 0 END, "offset" + 1, kind, errors, event_id, cvss_score FROM first_copy WHERE n % 3 = 0)"""


def w(*parts: str, select: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + select


def _bound(day: str) -> str:
    return f"DATE '{day}'"


PUB = [("1996-07-01", "1997-06-30"), ("1997-07-01", "1998-06-30"), ("1998-07-01", "1999-06-30"),
       ("1999-07-01", "2000-06-30"), ("2000-07-01", "2001-06-30")]
PUB_CASE = (
    "CASE "
    + " ".join(f"WHEN published_date BETWEEN {_bound(a)} AND {_bound(b)} THEN '{a}..{b}'" for a, b in PUB)
    + " ELSE 'OUTSIDE' END"
)
PUB_SPINE = "VALUES " + ", ".join(f"('{a}..{b}')" for a, b in PUB) + ", ('OUTSIDE')"

IN_SLICE = "published_ts >= TIMESTAMP '1997-01-01' AND published_ts < TIMESTAMP '1997-07-01'"
BLANK_VENDOR = "vendor IS NULL OR trim(vendor) = ''"
EMPTY = "({0} IS NULL OR {0} = '')"


def _dim(column: str, sentinel: str) -> str:
    return w(
        RECORDS,
        select=f"""SELECT {_key('m')} AS {column}_key, m AS {column} FROM (
  SELECT DISTINCT {column} AS m FROM records WHERE {column} IS NOT NULL AND {column} <> '' UNION SELECT '{sentinel}')""",
    )


def _fallback(column: str, sentinel: str) -> str:
    return f"coalesce(nullif({column}, ''), '{sentinel}')"


def _long(pairs: dict[str, str], source: str) -> str:
    return " UNION ALL ".join(f"SELECT '{m}' AS metric, cast({e} AS bigint) AS value FROM {source}" for m, e in pairs.items())


def _buckets(names: list[str], label: str, expression: str, source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS {label}, count(*) FILTER (WHERE {expression} = '{n}') AS records FROM {source}" for n in names
    )


SEVERITY_BUCKET = f"CASE WHEN {SEVERITY} IN ('NONE', 'LOW', 'MEDIUM', 'HIGH', 'CRITICAL') THEN {SEVERITY} ELSE 'null' END"
SEVERITIES = ["NONE", "LOW", "MEDIUM", "HIGH", "CRITICAL", "null"]
TYPES = ["vendor_direct", "third_party_db", "cert_national", "other"]
RESOLUTIONS = {"affected": "resolved_via_affected", "cpe_fallback": "resolved_via_cpe_fallback", "unresolved": "still_unresolved"}

# Expected class of each registered identifier, by position.
CLASSES = (
    ["other"] * 3 + ["vendor_direct"] * 3 + ["third_party_db"] * 2 + ["cert_national"] * 6
    + ["third_party_db"] + ["other"] * 3 + ["vendor_direct", "other"]
)

ROW_KEY = "line_no, part_no, supp_no"

SQL: dict[str, str] = {
    "id_filter": w(RECORDS, VALID, select=f"SELECT cve_id, {ROW_KEY} FROM valid"),
    "blank_counts": w(
        RECORDS,
        select="SELECT "
        + ", ".join(
            f"count(*) FILTER (WHERE {c} IS NULL OR trim(cast({c} AS varchar)) = '') AS missing_{c}"
            for c in ("vendor", "product", "severity", "cvss_score")
        )
        + " FROM records",
    ),
    "score_validity": w(
        RECORDS,
        select="SELECT order_no % 13 AS case_no, order_no % 13 NOT IN (0, 1, 2, 4, 5) AS valid, count(*) AS records FROM records GROUP BY ALL",
    ),
    "severity_rank": w(
        RECORDS, select=f"SELECT severity, cast({RANK} AS bigint) AS severity_rank, count(*) AS records FROM records GROUP BY ALL"
    ),
    "null_markers": w(
        RECORDS,
        select="""SELECT order_no % 7 AS case_no, CASE WHEN order_no % 7 < 4 THEN NULL WHEN order_no % 7 = 4 THEN 'x'
  WHEN order_no % 7 = 5 THEN 'Null' ELSE nullif(vendor, '') END AS value, count(*) AS records FROM records GROUP BY ALL""",
    ),
    "latest_wins": w(
        RECORDS, VALID, LATEST, select=f"SELECT cve_id, cast(cast(last_modified AS date) AS varchar) AS last_modified, {ROW_KEY}, price FROM latest"
    ),
    "duplicate_ids": w(RECORDS, select="SELECT cve_id, count(*) AS copies FROM records GROUP BY cve_id HAVING count(*) > 1 ORDER BY cve_id"),
    "quality_counts": w(
        RECORDS, VALID, LATEST,
        select=_long({"input_records": "count(*)"}, "records")
        + " UNION ALL " + _long({"output_records": "count(*)"}, "latest")
        + " UNION ALL SELECT 'duplicate_records_removed', (SELECT count(*) FROM valid) - (SELECT count(*) FROM latest)"
        + " UNION ALL SELECT 'records_dropped_invalid_cve_id', (SELECT count(*) FROM records) - (SELECT count(*) FROM valid)"
        + " UNION ALL " + _long(
            {
                "records_missing_cvss": "count(*) FILTER (WHERE cvss_score IS NULL)",
                "records_missing_description": "count(*) FILTER (WHERE product IS NULL OR trim(product) = '')",
                "records_missing_vendor": f"count(*) FILTER (WHERE {BLANK_VENDOR})",
            },
            "latest",
        ),
    ),
    "severity_buckets": w(RECORDS, VALID, LATEST, select=_buckets(SEVERITIES, "severity", SEVERITY_BUCKET, "latest")),
    "source_types": w(RECORDS, VALID, LATEST, select=_buckets(TYPES, "source_type", SOURCE_TYPE, "latest")),
    "source_classes": w(
        RECORDS,
        select="SELECT order_no % 20 AS case_no, CASE order_no % 20 "
        + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(CLASSES))
        + " END AS cve_source_type, count(*) AS records FROM records GROUP BY ALL",
    ),
    "date_range": w(
        RECORDS, LOADED,
        select="""SELECT strftime(min(published), '%Y-%m-%d %H:%M:%S') AS min_published, strftime(max(published), '%Y-%m-%d %H:%M:%S') AS max_published,
  cast(min(published_date) AS varchar) AS min_published_date, cast(max(published_date) AS varchar) AS max_published_date FROM loaded""",
    ),
    "date_parts": w(
        RECORDS,
        select=f"""SELECT cve_id, {ROW_KEY}, cast(d AS varchar) AS published_date, cast(year(d) AS bigint) AS year, cast(month(d) AS bigint) AS month,
  cast(quarter(d) AS bigint) AS quarter, cast(date_diff('day', d, DATE '2002-01-01') AS bigint) AS days_since_published
FROM (SELECT *, CASE WHEN order_no % 31 <> 0 THEN cast(published AS date) END AS d FROM records)""",
    ),
    "load_types": w(
        RECORDS,
        select=f"""SELECT cve_id, {ROW_KEY}, strftime(CASE order_no % 4 WHEN 0 THEN published WHEN 1 THEN published
  WHEN 2 THEN published - INTERVAL 2 HOUR END, '%Y-%m-%d %H:%M:%S') AS published_ntz FROM records""",
    ),
    "load_dups": w(
        RECORDS,
        select="SELECT count(*) AS row_count, count(DISTINCT cve_id) AS distinct_cve_id, count(*) - count(DISTINCT cve_id) AS duplicate_rows FROM records",
    ),
    "monthly_overview": w(
        RECORDS, LOADED,
        select="""SELECT year, month, count(*) AS total_cves, count(*) FILTER (WHERE severity = 'HIGH') AS high_cves,
  count(*) FILTER (WHERE severity = 'CRITICAL') AS critical_cves, count(*) FILTER (WHERE cvss_score IS NULL) AS missing_cvss
FROM loaded GROUP BY year, month""",
    ),
    "severity_share": w(
        RECORDS,
        select="""SELECT coalesce(nullif(severity, ''), 'MISSING') AS severity, count(*) AS cve_count,
  cast(round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS double) AS share_pct FROM records GROUP BY 1 ORDER BY cve_count DESC, severity""",
    ),
    "data_quality": w(
        RECORDS,
        select=f"""SELECT count(*) AS total_rows, count(DISTINCT cve_id) AS distinct_cve_id, count(*) - count(DISTINCT cve_id) AS duplicate_cve_id,
  count(*) FILTER (WHERE cvss_score IS NULL) AS missing_cvss, count(*) FILTER (WHERE {EMPTY.format('vendor')}) AS missing_vendor,
  count(*) FILTER (WHERE {EMPTY.format('product')}) AS missing_product FROM records""",
    ),
    "vendor_counts": w(
        RECORDS,
        select="""SELECT vendor, count(*) AS cve_count, count(DISTINCT cve_id) AS distinct_cve_count
FROM records WHERE vendor IS NOT NULL AND vendor <> '' GROUP BY vendor""",
    ),
    "top_vendors": w(
        RECORDS,
        select="""SELECT vendor, count(*) AS cve_count, count(DISTINCT cve_id) AS distinct_cve_count
FROM records WHERE vendor IS NOT NULL AND vendor <> '' GROUP BY vendor ORDER BY cve_count DESC, vendor LIMIT 10""",
    ),
    "version_counts": w(
        RECORDS,
        select="SELECT coalesce(cvss_version, 'NONE') AS cvss_version, count(*) AS cve_count FROM records GROUP BY 1 ORDER BY 1",
    ),
    "window_slice": w(RECORDS, NESTED, select=f"SELECT id, {ROW_KEY} FROM flat WHERE {IN_SLICE}"),
    "window_envelope": w(
        RECORDS, NESTED,
        select=f'SELECT count(*) AS "resultsPerPage", cast(0 AS bigint) AS "startIndex", count(*) AS "totalResults" FROM flat WHERE {IN_SLICE}',
    ),
    "modified_slice": w(
        RECORDS, NESTED,
        select=f"SELECT id, {ROW_KEY} FROM flat WHERE modified_ts >= TIMESTAMP '1998-01-01' AND modified_ts < TIMESTAMP '1998-04-01'",
    ),
    "chunk_coverage": w(
        RECORDS, LOADED,
        "spine AS (SELECT i AS chunk, cast(DATE '1995-03-01' + cast(i * 120 AS integer) AS date) AS chunk_start, "
        "cast(least(DATE '1995-03-01' + cast(i * 120 + 119 AS integer), DATE '2001-03-31') AS date) AS chunk_end FROM range(19) t(i))",
        select="""SELECT chunk, cast(chunk_start AS varchar) AS chunk_start, cast(chunk_end AS varchar) AS chunk_end, (SELECT count(*) FROM loaded WHERE published_date BETWEEN chunk_start AND chunk_end) AS records FROM spine
UNION ALL SELECT NULL, NULL, NULL, count(*) FROM loaded
WHERE published_date IS NULL OR published_date NOT BETWEEN DATE '1995-03-01' AND DATE '2001-03-31'""",
    ),
    "pub_windows": w(
        RECORDS, LOADED,
        select=f"""SELECT {PUB_CASE} AS publication_window, count(DISTINCT cve_id) AS distinct_cve_id,
  count(*) FILTER (WHERE cvss_score IS NULL) AS missing_cvss, count(*) FILTER (WHERE {BLANK_VENDOR}) AS missing_vendor FROM loaded GROUP BY 1""",
    ),
    "window_breakdown": w(
        RECORDS, LOADED,
        f"labelled AS (SELECT *, {PUB_CASE} AS w FROM loaded)",
        f"firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY w, cve_id ORDER BY {OLDEST}) AS rn FROM labelled WHERE w <> 'OUTSIDE') WHERE rn = 1)",
        f"""counts AS (SELECT w, count(*) AS records, count(*) FILTER (WHERE cvss_score IS NULL) AS mc, count(*) FILTER (WHERE {BLANK_VENDOR}) AS mv
  FROM firsts GROUP BY w UNION ALL SELECT 'OUTSIDE', count(*), 0, 0 FROM labelled WHERE w = 'OUTSIDE')""",
        select=f"""SELECT s.w AS "window", coalesce(records, 0) AS records, coalesce(mc, 0) AS missing_cvss, coalesce(mv, 0) AS missing_vendor,
  CASE WHEN s.w <> 'OUTSIDE' THEN round(cast(mc AS double) * 100.0 / records, 2) END AS missing_cvss_pct,
  CASE WHEN s.w <> 'OUTSIDE' THEN round(cast(mv AS double) * 100.0 / records, 2) END AS missing_vendor_pct
FROM ({PUB_SPINE}) s(w) LEFT JOIN counts c ON s.w = c.w""",
    ),
    "first_per_window": w(
        RECORDS, LOADED,
        f"labelled AS (SELECT *, {PUB_CASE} AS w FROM loaded)",
        select=f"""SELECT w AS "window", cve_id, {ROW_KEY} FROM (SELECT *, row_number() OVER (PARTITION BY w, cve_id ORDER BY {OLDEST}) AS rn
  FROM labelled WHERE w <> 'OUTSIDE') WHERE rn = 1""",
    ),
    "dim_vendor": _dim("vendor", "UNKNOWN"),
    "dim_product": _dim("product", "UNKNOWN"),
    "dim_severity": _dim("severity", "MISSING"),
    "dim_date": w(
        RECORDS, LOADED,
        select=f"SELECT {_key('published_date')} AS date_key, * REPLACE (cast(published_date AS varchar) AS published_date) FROM (SELECT DISTINCT published_date, year, month, quarter FROM loaded)",
    ),
    "star_fact": w(
        RECORDS, LOADED,
        select=f"""SELECT cve_id, {_key(_fallback('vendor', 'UNKNOWN'))} AS vendor_key, {_key(_fallback('product', 'UNKNOWN'))} AS product_key,
  {_key(_fallback('severity', 'MISSING'))} AS severity_key, {_key('published_date')} AS date_key, cvss_score, severity_rank, days_since_published FROM loaded""",
    ),
    "star_join": w(
        RECORDS, LOADED,
        select=f"""SELECT {_fallback('vendor', 'UNKNOWN')} AS vendor, {_fallback('severity', 'MISSING')} AS severity, year, count(*) AS facts,
  count(DISTINCT {_fallback('product', 'UNKNOWN')}) AS products, count(cvss_score) AS scored FROM loaded GROUP BY 1, 2, 3""",
    ),
    "star_tables": w(
        RECORDS, LOADED,
        select=f"""SELECT {_fallback('vendor', 'UNKNOWN')} AS vendor, {_fallback('severity', 'MISSING')} AS severity, year, count(*) AS facts,
  count(DISTINCT {_fallback('product', 'UNKNOWN')}) AS products, count(cvss_score) AS scored FROM loaded GROUP BY 1, 2, 3""",
    ),
    "load_verify": w(
        RECORDS, LOADED,
        select=_long(
            {
                "facts": "count(*)",
                **{f"{n}": f"count(DISTINCT nullif({c}, '')) + 1" for n, c in {"vendors": "vendor", "products": "product", "severities": "severity"}.items()},
                "shared": "count(*)",
                "named": "count(*) FILTER (WHERE vendor <> '')",
                "duplicates": "count(*) - count(DISTINCT cve_id)",
            },
            "loaded",
        )
        + " UNION ALL "
        + _long({"dates": "count(*)"}, "(SELECT DISTINCT published_date FROM loaded) AS d")
        + " UNION ALL "
        + _long({"months": "count(*)"}, "(SELECT DISTINCT year, month FROM loaded) AS m"),
    ),
    "star_orphans": w(
        RECORDS, LOADED,
        select=f"""SELECT DISTINCT 'vendor' AS dimension, {_key('vendor')} AS orphan_key FROM loaded WHERE vendor IN ('Brand#13', 'Brand#5', 'Brand#7')
UNION ALL SELECT DISTINCT 'product', {_key('product')} FROM loaded WHERE product <> '' AND product < 'm'
UNION ALL SELECT DISTINCT 'severity', {_key('severity')} FROM loaded WHERE severity = 'CRITICAL'
UNION ALL SELECT DISTINCT 'date', {_key('published_date')} FROM loaded WHERE published_date >= DATE '2001-01-01'""",
    ),
    "schema_align": w(RECORDS, select="SELECT cve_id, vendor, cvss_score, cast(NULL AS varchar) AS affected_status FROM records"),
    "load_append_dups": w(
        RECORDS, VALID, LATEST,
        "both_loads AS (SELECT cve_id FROM latest UNION ALL SELECT cve_id FROM latest WHERE vendor = 'Brand#5')",
        select="SELECT count(*) AS row_count, count(DISTINCT cve_id) AS distinct_cve_id, count(*) - count(DISTINCT cve_id) AS duplicate_rows FROM both_loads",
    ),
    "load_reconcile": w(
        RECORDS, VALID, LATEST,
        *[
            f"{side} AS ("
            + _long(
                {
                    "output_records": "count(*)",
                    "missing_cvss": "count(*) FILTER (WHERE cvss_score IS NULL)",
                    "missing_vendor": f"count(*) FILTER (WHERE {BLANK_VENDOR})",
                    "distinct_cve_id": "count(DISTINCT cve_id)",
                    **({"products": "count(product)"} if side == "b" else {}),
                },
                source,
            )
            + ")"
            for side, source in (("a", "latest"), ("b", "valid"))
        ],
        select="""SELECT coalesce(a.metric, b.metric) AS metric, a.value AS left_value, b.value AS right_value,
  coalesce(a.value = b.value, false) AS matches FROM a FULL JOIN b ON a.metric = b.metric""",
    ),
    "row_reconcile": w(
        RECORDS, VALID, LATEST,
        f"firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cve_id ORDER BY {OLDEST}) AS rn FROM valid) WHERE rn = 1)",
        f"a AS (SELECT cve_id, {ROW_KEY} FROM firsts)", f"b AS (SELECT cve_id, {ROW_KEY} FROM latest)",
        select="SELECT *, 'left' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT *, 'right' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)",
    ),
    "incremental_upsert": w(
        RECORDS, VALID,
        select=f"""SELECT cve_id, cast(cast(last_modified AS date) AS varchar) AS last_modified, {ROW_KEY} FROM (
  SELECT *, row_number() OVER (PARTITION BY cve_id ORDER BY {NEWEST}) AS rn FROM valid) WHERE rn = 1""",
    ),
    "feed_flatten": w(
        RECORDS, NESTED,
        select=f"""SELECT {CLEANED} FROM (SELECT * REPLACE (concat_ws('|', vuln_status, line_no, part_no, supp_no) AS vuln_status), id AS cve_id FROM flat)""",
    ),
    "batch_cleaned": w(
        RECORDS, NESTED,
        """tagged AS (SELECT * REPLACE (concat_ws('|', lpad(cast(line_no AS varchar), 12, '0'), lpad(cast(part_no AS varchar), 12, '0'),
  lpad(cast(supp_no AS varchar), 12, '0')) AS vuln_status), id AS cve_id FROM flat WHERE regexp_full_match(id, 'CVE-[0-9]{4}-[0-9]+'))""",
        select=f"""SELECT {CLEANED} FROM (SELECT *, row_number() OVER (PARTITION BY cve_id ORDER BY modified_ts DESC, vuln_status DESC) AS rn FROM tagged) WHERE rn = 1""",
    ),
    "quality_report": w(
        RECORDS, NESTED,
        """tagged AS (SELECT * REPLACE (concat_ws('|', lpad(cast(line_no AS varchar), 12, '0'), lpad(cast(part_no AS varchar), 12, '0'),
  lpad(cast(supp_no AS varchar), 12, '0')) AS vuln_status), id AS cve_id FROM flat WHERE regexp_full_match(id, 'CVE-[0-9]{4}-[0-9]+')),
  newest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cve_id ORDER BY modified_ts DESC, vuln_status DESC) AS rn FROM tagged) WHERE rn = 1)""",
        select=_long(
            {
                "input_records": "(SELECT count(*) FROM flat)",
                "output_records": "(SELECT count(*) FROM newest)",
                "duplicate_records_removed": "(SELECT count(*) FROM tagged) - (SELECT count(*) FROM newest)",
                "records_dropped_invalid_cve_id": "(SELECT count(*) FROM flat) - (SELECT count(*) FROM tagged)",
                "records_bad_published": "0",
            },
            "(SELECT 1) AS one",
        )
        + " UNION ALL "
        + _long(
            {
                "records_missing_cvss": "count(*) FILTER (WHERE cvss_score IS NULL)",
                "records_missing_description": "count(*) FILTER (WHERE description_en IS NULL OR trim(description_en) = '')",
                "records_missing_vendor": f"count(*) FILTER (WHERE {BLANK_VENDOR})",
                "min_published_date": "strftime(min(cast(published_ts AS date)), '%Y%m%d')",
                "max_published_date": "strftime(max(cast(published_ts AS date)), '%Y%m%d')",
                **{f"vendor_resolution.{b}": f"count(*) FILTER (WHERE vendor_source = '{k}')" for k, b in RESOLUTIONS.items()},
                **{f"source_type_distribution.{t}": f"count(*) FILTER (WHERE {SOURCE_TYPE} = '{t}')" for t in TYPES},
                **{f"severity_distribution.{s}": f"count(*) FILTER (WHERE {SEVERITY_BUCKET} = '{s}')" for s in SEVERITIES},
            },
            "newest",
        ),
    ),
    "first_lang_text": w(RECORDS, NESTED, select=f"SELECT id, {ROW_KEY}, description_en FROM flat"),
    "metric_priority": w(
        RECORDS, NESTED,
        select=f"""SELECT id, {ROW_KEY}, cvss_version, cvss_score, severity, attack_vector, attack_complexity, privileges_required, user_interaction FROM flat""",
    ),
    "metric_coherent": w(
        RECORDS, NESTED,
        "c AS (SELECT *, CASE WHEN has31 THEN 'NETWORK' WHEN has30 THEN 'LOCAL' WHEN has2 THEN NULL WHEN has40 THEN 'PHYSICAL' END AS cv FROM flat)",
        select=f"""SELECT id, {ROW_KEY}, cvss_version, CASE WHEN has31 AND k % 15 = 0 THEN NULL ELSE cvss_score END AS cvss_score, severity,
  cv AS attack_vector, lower(cv) AS attack_complexity, cv || '-PR' AS privileges_required, cv || '-UI' AS user_interaction FROM c""",
    ),
    "array_join_distinct": w(RECORDS, NESTED, select=f"SELECT id, {ROW_KEY}, cwe_ids FROM flat"),
    "cpe_parse": w(
        RECORDS,
        "named AS (SELECT *, concat('maker', cast(supp_no % 10 AS varchar)) AS maker, order_no % 6 AS c FROM records)",
        select=f"""SELECT cve_id, {ROW_KEY}, CASE WHEN c IN (0, 1) THEN maker ELSE '' END AS vendor, CASE WHEN c = 0 THEN 'tool' ELSE '' END AS product,
  CASE WHEN c = 0 THEN cast(supp_no % 7 AS varchar) ELSE '' END AS version, CASE WHEN c IN (0, 1) THEN 'a' ELSE '' END AS part,
  CASE c WHEN 0 THEN concat('cpe:2.3:a:', maker, ':tool:', cast(supp_no % 7 AS varchar), ':*:*:*:*:*:*:*')
         WHEN 1 THEN concat('cpe:2.3:a:', maker, ':*:-:*:*:*:*:*:*:*') ELSE '' END AS cpe_uri FROM named""",
    ),
    "cpe_first": w(RECORDS, NESTED, select=f"SELECT id, {ROW_KEY}, uri AS cpe_uri FROM flat"),
    "affected_resolve": w(
        RECORDS, NESTED,
        select=f"SELECT id, {ROW_KEY}, vendor, product, cpe_uri, affected_status, affected_version_range, vendor_source FROM flat",
    ),
    "affected_status": w(
        RECORDS, select="SELECT part_no % 6 AS case_no, CASE WHEN part_no % 6 > 2 THEN 'affected' ELSE '' END AS affected_status, count(*) AS records FROM records GROUP BY ALL"
    ),
    "vendor_resolution": w(
        RECORDS, NESTED,
        select=" UNION ALL ".join(
            f"SELECT '{b}' AS resolution, count(*) FILTER (WHERE vendor_source = '{k}') AS records FROM flat" for k, b in RESOLUTIONS.items()
        ),
    ),
    "metric_coverage": w(
        RECORDS, NESTED,
        f"""newest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY modified_ts DESC, line_no DESC, part_no DESC, supp_no DESC, price DESC) AS rn
  FROM flat WHERE {IN_SLICE}) WHERE rn = 1)""",
        """counts AS (SELECT count(*) AS records,
  count(*) FILTER (WHERE NOT (has31 AND k % 15 <> 0) AND NOT has30 AND NOT has2) AS missing_cvss,
  count(*) FILTER (WHERE NOT (has31 AND k % 15 <> 0) AND NOT has30 AND NOT has2 AND has40) AS missing_but_has_v40,
  count(*) FILTER (WHERE has40) AS has_v40_any FROM newest)""",
        select="""SELECT '1997-01-01..1997-06-30' AS "window", *, round(cast(missing_cvss AS double) * 100.0 / records, 2) AS missing_cvss_pct,
  round(cast(missing_but_has_v40 AS double) * 100.0 / records, 2) AS missing_but_has_v40_pct,
  round(cast(has_v40_any AS double) * 100.0 / records, 2) AS has_v40_any_pct FROM counts""",
    ),
    "page_merge": w(
        RECORDS,
        select="""SELECT cve_id AS id, sum(CASE order_no % 6 WHEN 2 THEN 2 ELSE 1 END)::bigint AS records FROM records
WHERE order_no % 6 NOT IN (0, 1) GROUP BY cve_id""",
    ),
    "page_audit": w(
        RECORDS,
        "paged AS (SELECT *, cast(floor(date_diff('day', DATE '1995-01-01', cast(published AS date)) / 7) AS bigint) AS week FROM records)",
        select="""SELECT week AS "window", count(*) AS pages, fetched, expected, fetched >= expected AS complete FROM (
  SELECT week, sum(CASE order_no % 6 WHEN 0 THEN 0 WHEN 1 THEN 0 WHEN 2 THEN 2 ELSE 1 END)::bigint AS fetched, max(100 + week % 100) AS expected
  FROM paged GROUP BY week) t JOIN paged USING (week) GROUP BY ALL""",
    ),
    "event_build": w(EVENTS, select=f"SELECT {EVENT_COLUMNS} FROM built"),
    "contract_errors": w(EVENTS, CHECKED, select="SELECT n, errors = '' AS ok, errors FROM checked"),
    "event_json": w(
        EVENTS,
        select="SELECT cve_id AS key, cast(to_json({"
        + ", ".join(f"'{c.strip()}': {c.strip()}" for c in EVENT_COLUMNS.split(","))
        + "}) AS varchar) AS value FROM built",
    ),
    "event_route": w(EVENTS, CHECKED, ROUTED, select='SELECT "partition", "offset", kind, errors FROM routed'),
    "event_quarantine": w(
        EVENTS, CHECKED, ROUTED,
        select="SELECT kind, count(*) AS messages, count(*) FILTER (WHERE n % 23 <> 5) AS with_value FROM routed WHERE kind <> 'valid' GROUP BY kind",
    ),
    "event_enrich": w(
        EVENTS, CHECKED, ROUTED,
        select=f"""SELECT event_id, cvss_score, '{NOW}' AS ingested_at, 'events' AS kafka_topic, "partition" AS kafka_partition, "offset" AS kafka_offset
FROM routed WHERE kind = 'valid'""",
    ),
    "event_batch_dedupe": w(
        EVENTS, CHECKED, ROUTED,
        select="""SELECT event_id, "partition", "offset" FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY "partition", "offset") AS rn FROM routed) WHERE rn = 1 OR event_id IS NULL""",
    ),
    "event_idempotent": w(
        EVENTS, CHECKED, ROUTED,
        select="""SELECT event_id, "partition", "offset" FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY "partition", "offset") AS rn FROM routed WHERE kind = 'valid')
WHERE rn = 1 AND event_id NOT IN (SELECT event_id FROM routed WHERE kind = 'valid' AND n % 4 = 0)""",
    ),
    "event_ledger": w(
        EVENTS, CHECKED, ROUTED,
        """marked AS (SELECT *, n // 1000 AS batch,
  kind = 'valid' AND row_number() OVER (PARTITION BY kind, event_id ORDER BY "partition", "offset") = 1 AS stored FROM routed)""",
        select="""SELECT batch, count(*) FILTER (WHERE kind IN ('valid', 'invalid')) AS consumed, count(*) FILTER (WHERE stored) AS inserted,
  count(*) FILTER (WHERE kind = 'valid' AND NOT stored) AS duplicates, count(*) FILTER (WHERE kind = 'invalid') AS invalid,
  count(*) FILTER (WHERE kind IN ('not_json', 'not_object')) AS skipped FROM marked GROUP BY batch""",
    ),
    "replay_limit": w(EVENTS, CHECKED, select="SELECT n, event_id, cve_id FROM checked WHERE errors = '' ORDER BY n LIMIT 50"),
    "limit_consumed": w(
        EVENTS, CHECKED, ROUTED,
        select="""SELECT "partition", "offset", n FROM routed WHERE kind IN ('valid', 'invalid') ORDER BY "partition", "offset" LIMIT 40""",
    ),
    "log_summary": """SELECT event_id AS line_no, CASE event_id % 5 WHEN 2 THEN concat('{"k": 1, "records": ', cast(event_id AS varchar), '}')
  ELSE concat('{"records": ', cast(event_id AS varchar), ', "k": 2}') END AS summary
FROM events WHERE event_id = (SELECT max(event_id) FROM events WHERE event_id % 5 IN (2, 4))""",
    "uri_redact": """SELECT page_id, concat(lower(split_part(url, '://', 1)), '://', lower(regexp_extract(url, '^[a-z]+://([^/?#]+)', 1)),
  CASE WHEN page_id % 4 = 2 THEN ':8080' ELSE '' END) AS uri FROM pages""",
    "run_stats": """SELECT label, count(d) AS repeats, round(avg(d), 1) AS mean_s, min(d) AS min_s, max(d) AS max_s, round(max(d) - min(d), 1) AS spread_s,
  round(stddev_samp(d), 1) AS stdev_s
FROM (SELECT o_orderpriority AS label, CASE WHEN o_orderkey % 31 = 0 THEN 0.0::double WHEN o_orderkey % 29 = 0 THEN NULL ELSE o_totalprice END AS d FROM orders) GROUP BY label""",
    "run_throughput": """SELECT run_no, CASE WHEN d > 0 AND r <> 0 THEN round(r / d, 1) END AS throughput_per_second
FROM (SELECT o_orderkey AS run_no, CASE WHEN o_orderkey % 31 = 0 THEN 0.0::double WHEN o_orderkey % 29 = 0 THEN NULL ELSE o_totalprice END AS d,
  CASE WHEN o_orderkey % 37 = 0 THEN NULL WHEN o_orderkey % 41 = 0 THEN 0 ELSE o_custkey END AS r FROM orders)""",
}

# ---------------------------------------------------------------- queries that write and read back

STATUS = "concat_ws('|', vuln_status, line_no, part_no, supp_no)"
LATER = "modified_ts + to_milliseconds(line_no * 3600000 + part_no * 1000 + supp_no)"
STAMPED = f"""stamped AS (SELECT * REPLACE ({STATUS} AS vuln_status, {LATER} AS modified_ts, strftime({LATER}, '%Y-%m-%dT%H:%M:%S.%g') AS last_modified),
  id AS cve_id FROM flat WHERE regexp_full_match(id, 'CVE-[0-9]{{4}}-[0-9]+'))"""
NEWEST_STAMPED = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cve_id ORDER BY modified_ts DESC, vuln_status DESC) AS turn FROM stamped {0}) WHERE turn = 1"
ARRIVED = """arrived AS (SELECT *, (n % 4 <> 0 AND "offset" % 2 = 0) OR (n % 6 = 3 AND "offset" % 2 = 1) AS early FROM routed),
placed AS (SELECT *, row_number() OVER (PARTITION BY kind, event_id ORDER BY early DESC, "partition", "offset") AS turn FROM arrived)"""

SQL |= {
    "feed_parse": SQL["feed_flatten"],
    "feed_quarantine": w(
        RECORDS, NESTED,
        select="""SELECT 'file' AS kind, k // 500 AS what, cast(1 AS bigint) AS n FROM flat WHERE (k // 500) % 7 = 3 GROUP BY 2
  UNION ALL SELECT 'year', cast(year(published_ts) AS bigint), count(*) FROM flat WHERE (k // 500) % 7 <> 3 GROUP BY 2""",
    ),
    "bronze_roundtrip": w(
        RECORDS, NESTED,
        select=f"SELECT id, {STATUS} AS status, cast(year(published_ts) AS bigint) AS pub_year, line_no, cast(price AS double) AS price FROM flat",
    ),
    "bronze_slice": w(
        RECORDS, NESTED,
        select=f"SELECT id, {STATUS} AS status FROM flat WHERE modified_ts >= TIMESTAMP '1998-01-01' AND modified_ts < TIMESTAMP '1998-04-01'",
    ),
    "incremental_landing": w(
        RECORDS, NESTED, STAMPED,
        select=f"""SELECT cve_id, last_modified, vuln_status, severity, cast(substr(cve_id, 5, 4) AS bigint) AS id_year,
  cast(date_diff('day', cast(published_ts AS date), DATE '2002-01-01') AS bigint) AS days_since_published
FROM ({NEWEST_STAMPED.format("WHERE k % 4 <> 2")})""",
    ),
    "incremental_marts": w(
        RECORDS, NESTED, STAMPED, f"kept AS (SELECT {CLEANED} FROM ({NEWEST_STAMPED.format('')}))",
        select="""SELECT 'monthly_overview' AS mart, year, month, count(*) AS total_cves, count(*) FILTER (WHERE severity = 'HIGH') AS high_cves,
  count(*) FILTER (WHERE severity = 'CRITICAL') AS critical_cves, count(*) FILTER (WHERE cvss_score IS NULL) AS missing_cvss,
  NULL AS severity, NULL AS cve_count, NULL AS share_pct, NULL AS total_rows, NULL AS distinct_cve_id, NULL AS missing_vendor, NULL AS missing_product,
  NULL AS duplicate_cve_id, NULL AS vendor, NULL AS distinct_cve_count, NULL AS cvss_version FROM kept GROUP BY year, month
UNION ALL BY NAME SELECT 'severity_share' AS mart, coalesce(nullif(severity, ''), 'MISSING') AS severity, count(*) AS cve_count,
  cast(round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS double) AS share_pct FROM kept GROUP BY 2
UNION ALL BY NAME SELECT 'data_quality' AS mart, count(*) AS total_rows, count(DISTINCT cve_id) AS distinct_cve_id, count(*) - count(DISTINCT cve_id) AS duplicate_cve_id,
  count(*) FILTER (WHERE cvss_score IS NULL) AS missing_cvss, count(*) FILTER (WHERE coalesce(vendor, '') = '') AS missing_vendor,
  count(*) FILTER (WHERE coalesce(product, '') = '') AS missing_product FROM kept
UNION ALL BY NAME SELECT 'vendor_counts' AS mart, vendor, count(*) AS cve_count, count(DISTINCT cve_id) AS distinct_cve_count
  FROM kept WHERE vendor <> '' GROUP BY vendor
UNION ALL BY NAME SELECT 'version_counts' AS mart, coalesce(cvss_version, 'NONE') AS cvss_version, count(*) AS cve_count FROM kept GROUP BY 2""",
    ),
    "incremental_star": w(
        RECORDS, NESTED, STAMPED, f"kept AS (SELECT {CLEANED} FROM ({NEWEST_STAMPED.format('')}))",
        select=f"""SELECT {_fallback('vendor', 'UNKNOWN')} AS vendor, {_fallback('severity', 'MISSING')} AS severity, year, count(*) AS facts,
  count(DISTINCT {_fallback('product', 'UNKNOWN')}) AS products, count(cvss_score) AS scored, cast(sum(severity_rank) AS bigint) AS ranks,
  cast(sum(days_since_published) AS bigint) AS days FROM kept GROUP BY 1, 2, 3""",
    ),
    "cleaned_roundtrip": w(
        RECORDS, NESTED, STAMPED, f"newest AS ({NEWEST_STAMPED.format('')})", f"shown AS (SELECT {CLEANED}, count(*) OVER () AS \"of\" FROM newest)",
        select="SELECT *, 'parquet' AS form FROM shown UNION ALL SELECT *, 'csv' FROM shown",
    ),
    "load_reload": w(
        RECORDS, NESTED, STAMPED, f"newest AS ({NEWEST_STAMPED.format('')})",
        select="""SELECT cast(year(published_ts) AS bigint) AS year, cast(month(published_ts) AS bigint) AS month,
  cast(CASE WHEN year(published_ts) = 1996 THEN 2 ELSE 1 END AS bigint) AS copies, count(*) AS ids,
  cast(count(severity) * CASE WHEN year(published_ts) = 1996 THEN 2 ELSE 1 END AS bigint) AS with_severity, cast(18 AS bigint) AS added
FROM newest GROUP BY year(published_ts), month(published_ts)""",
    ),
    "log_folder": """SELECT concat('{"k": 1, "records": ', cast(max(event_id) AS varchar), '}') AS summary FROM events WHERE event_id % 3 = 0""",
    "stream_ingest": w(
        EVENTS, CHECKED, ROUTED, ARRIVED,
        select="""SELECT event_id, "partition", "offset" FROM placed WHERE kind = 'valid' AND turn = 1""",
    ),
    "stream_ledger": w(
        EVENTS, CHECKED, ROUTED, ARRIVED,
        "copies AS (SELECT *, CASE WHEN early THEN 4 ELSE 2 END AS times FROM placed)",
        select="""SELECT cast(sum(times) FILTER (WHERE kind IN ('valid', 'invalid')) AS bigint) AS consumed,
  count(*) FILTER (WHERE kind = 'valid' AND turn = 1) AS inserted,
  cast(sum(times) FILTER (WHERE kind = 'valid') - count(*) FILTER (WHERE kind = 'valid' AND turn = 1) AS bigint) AS duplicates,
  cast(sum(times) FILTER (WHERE kind = 'invalid') AS bigint) AS invalid,
  cast(sum(times) FILTER (WHERE kind IN ('not_json', 'not_object')) AS bigint) AS skipped,
  cast(sum(times) FILTER (WHERE kind <> 'valid') AS bigint) AS quarantined FROM copies""",
    ),
    "stream_bound": w(
        EVENTS, CHECKED, ROUTED,
        """counted AS (SELECT * FROM routed WHERE kind IN ('valid', 'invalid') ORDER BY "partition", "offset" LIMIT 900)""",
        select="""SELECT event_id, "partition", "offset" FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY "partition", "offset") AS turn FROM counted WHERE kind = 'valid') WHERE turn = 1""",
    ),
    "stream_replay": w(
        EVENTS, CHECKED,
        """own AS (SELECT cve_id, severity, cvss_score, vendor, n % 37 = 0 OR n % 41 = 0 OR n % 43 = 0 OR n % 47 = 0 OR n % 53 = 0 OR cvss_score > 10 AS broken FROM checked)""",
        select="""SELECT cve_id, severity, cvss_score, vendor, true AS has_id, count(*) OVER () AS sent, (SELECT count(*) FROM own WHERE broken) AS skipped
FROM own WHERE coalesce(broken, false) = false""",
    ),
}
