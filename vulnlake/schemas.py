"""Explicit schemas of every layer.

Nothing is inferred: an empty page, or a batch in which no record carries a
given metric block, must read as nulls instead of failing analysis, and an
explicit schema also saves the extra pass inference needs.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_S = T.StringType()

CVSS_DATA = _struct(
    ("version", _S),
    ("baseScore", _S),  # feeds write it as a number or as text; it is cast where it is used
    ("baseSeverity", _S),
    ("attackVector", _S),
    ("attackComplexity", _S),
    ("privilegesRequired", _S),
    ("userInteraction", _S),
)

METRIC = _struct(("cvssData", CVSS_DATA), ("baseSeverity", _S))

METRICS = _struct(
    ("cvssMetricV31", T.ArrayType(METRIC)),
    ("cvssMetricV30", T.ArrayType(METRIC)),
    ("cvssMetricV2", T.ArrayType(METRIC)),
    ("cvssMetricV40", T.ArrayType(METRIC)),
)

AFFECTED_DATA = _struct(
    ("vendor", _S),
    ("product", _S),
    ("defaultStatus", _S),
    ("versions", T.ArrayType(_struct(("version", _S), ("status", _S)))),
    ("cpes", T.ArrayType(_S)),
)

AFFECTED = T.ArrayType(_struct(("source", _S), ("affectedData", T.ArrayType(AFFECTED_DATA))))

CONFIGURATIONS = T.ArrayType(
    _struct(("nodes", T.ArrayType(_struct(("cpeMatch", T.ArrayType(_struct(("criteria", _S))))))))
)

RECORD_SCHEMA = _struct(
    ("id", _S),
    ("published", _S),
    ("lastModified", _S),
    ("vulnStatus", _S),
    ("sourceIdentifier", _S),
    ("descriptions", T.ArrayType(_struct(("lang", _S), ("value", _S)))),
    ("metrics", METRICS),
    ("weaknesses", T.ArrayType(_struct(("description", T.ArrayType(_struct(("value", _S))))))),
    ("affected", AFFECTED),
    ("configurations", CONFIGURATIONS),
)

CORRUPT_COLUMN = "_corrupt_record"
RAW_COLUMN = "raw"

FEED_SCHEMA = _struct(
    ("resultsPerPage", T.LongType()),
    ("startIndex", T.LongType()),
    ("totalResults", T.LongType()),
    ("format", _S),
    ("version", _S),
    ("timestamp", _S),
    ("vulnerabilities", T.ArrayType(_struct(("cve", RECORD_SCHEMA)))),
)

# The envelope as it is scanned: each record stays JSON text, so fields without a place in RECORD_SCHEMA are kept.
ENVELOPE_SCHEMA = T.StructType(
    [f for f in FEED_SCHEMA.fields if f.name != "vulnerabilities"]
    + [T.StructField("vulnerabilities", T.ArrayType(_struct(("cve", _S))), True)]
)

# Column order of the cleaned layer (fixed values: names and order are the contract).
CLEANED_SCHEMA = _struct(
    ("cve_id", _S),
    ("published", _S),
    ("published_date", T.DateType()),
    ("year", T.IntegerType()),
    ("month", T.IntegerType()),
    ("quarter", T.IntegerType()),
    ("days_since_published", T.IntegerType()),
    ("last_modified", _S),
    ("vuln_status", _S),
    ("description_en", _S),
    ("cvss_version", _S),
    ("cvss_score", T.DoubleType()),
    ("severity", _S),
    ("severity_rank", T.IntegerType()),
    ("attack_vector", _S),
    ("attack_complexity", _S),
    ("privileges_required", _S),
    ("user_interaction", _S),
    ("cwe_ids", _S),
    ("vendor", _S),
    ("product", _S),
    ("cpe_uri", _S),
    ("source_identifier", _S),
    ("cve_source_type", _S),
    ("affected_status", _S),
    ("affected_version_range", _S),
)

CLEANED_COLUMNS = CLEANED_SCHEMA.fieldNames()

# The warehouse copy of the cleaned layer types its two ISO texts.
WAREHOUSE_SCHEMA = T.StructType(
    [
        T.StructField(f.name, T.TimestampNTZType(), True) if f.name in ("published", "last_modified") else f
        for f in CLEANED_SCHEMA.fields
    ]
)

EVENT_SCHEMA = _struct(
    ("event_id", _S),
    ("event_timestamp", _S),
    ("event_type", _S),
    ("source", _S),
    ("cve_id", _S),
    ("published", _S),
    ("last_modified", _S),
    ("cvss_score", T.DoubleType()),
    ("severity", _S),
    ("vendor", _S),
    ("product", _S),
    ("description", _S),
    ("raw_cpe_uri", _S),
)

EVENT_COLUMNS = EVENT_SCHEMA.fieldNames()

# A broker message as the routing operators see it.
MESSAGE_SCHEMA = _struct(
    ("topic", _S),
    ("partition", T.IntegerType()),
    ("offset", T.LongType()),
    ("value", _S),
)
