"""Column functions, case by case."""

import uuid

import pytest
from pyspark.sql import functions as F

from vulnlake.functions import dates, ids, products, scores, sources, text, uris

WORD = "cpe:2.3:a:microsoft:word:2016:*:*:*:*:*:*:*"


def test_severity_rank(evaluate):
    values = ["CRITICAL", "critical", " High ", "\tlow\n", "NONE", "Medium", None, "", "UNKNOWN"]
    assert evaluate(scores.severity_rank, values) == [4, 4, 3, 1, 0, 2, None, None, None]


def test_valid_id(evaluate):
    good = ["CVE-2026-12345", "CVE-1999-1"]
    bad = ["CVE-202-123", "CVE-2026-ABC", "cve-2026-1", "CVE-2026", "CVE-2026--1", None, "CVE-2026-1\n", " CVE-2026-1"]
    assert evaluate(ids.is_valid_id, good + bad) == [True] * len(good) + [False] * len(bad)


def test_valid_score(evaluate):
    good = ["0", "10", "5.5", None, "7.5", "", "  ", " 7 ", "1e1"]
    bad = ["-0.1", "10.1", "abc", "true", "NaN", "inf", "5d"]
    assert evaluate(scores.is_valid_score, good + bad) == [True] * len(good) + [False] * len(bad)


def test_valid_score_of_numbers(evaluate):
    assert evaluate(scores.is_valid_score, [0.0, 10.0, None, 10.1, float("nan")], "double") == [True, True, True, False, False]


def test_to_score(evaluate):
    assert evaluate(scores.to_score, ["9.8", "0", None, "", "   ", "N/A", "abc", "5d", " 3 "]) == [
        9.8, 0.0, None, None, None, None, None, None, 3.0
    ]


def test_strip_and_blank(evaluate):
    values = [None, "", " \t\n", "  ", " a ", "　b\r\n"]
    assert evaluate(text.is_blank, values) == [True, True, True, True, False, False]
    assert evaluate(text.strip, values)[4:] == ["a", "b"]
    assert evaluate(text.nullify, values) == [None, None, None, None, " a ", "　b\r\n"]


def test_default_blank_does_not_trim(evaluate):
    assert evaluate(lambda c: text.default_blank(c, "UNKNOWN"), [None, "", " ", "x"]) == ["UNKNOWN", "UNKNOWN", " ", "x"]


def test_placeholders(evaluate):
    words = ["n/a", " N/A ", "NA", "Unknown", "none", "-", "*", "Not Available", "", None]
    assert evaluate(text.clean_placeholder, words) == [""] * len(words)
    assert evaluate(text.clean_placeholder, [" acme ", "nav"]) == ["acme", "nav"]


def test_first_nonblank_and_join(evaluate):
    arrays = [None, [], [None, " ", " a ", "b"], ["a", None, "", "a", "b"]]
    assert evaluate(text.first_nonblank, arrays, "array<string>") == ["", "", "a", "a"]
    assert evaluate(text.join_distinct, arrays, "array<string>") == ["", "", " a ,b", "a,b"]


@pytest.mark.parametrize(
    "value,expected",
    [
        ("secure@microsoft.com", "vendor_direct"),
        ("cna@vuldb.com", "third_party_db"),
        ("ics-cert@hq.dhs.gov", "cert_national"),
        ("cve@mitre.org", "other"),
        (None, "other"),
        (" ", "other"),
        ("desk@agency.gov.uk", "cert_national"),
        ("concert@github.com", "cert_national"),
        ("a@b@SNYK.io ", "third_party_db"),
    ],
)
def test_source_type(evaluate, value, expected):
    assert evaluate(sources.source_type, [value]) == [expected]


def test_parse_cpe(evaluate):
    def row(value):
        return tuple(evaluate(products.parse_cpe, [value])[0])

    assert row(WORD) == ("microsoft", "word", "2016", "a", WORD)
    assert row(f" {WORD}\n") == ("microsoft", "word", "2016", "a", WORD)
    assert row("cpe:2.3:o:linux:linux_kernel:5.15:*:*:*:*:*:*:*")[:4] == ("linux", "linux_kernel", "5.15", "o")
    assert row("cpe:2.3:a:microsoft:*:-:*:*:*:*:*:*:*")[:3] == ("microsoft", "", "")
    for broken in (None, "", "not-a-cpe-at-all", "cpe:/a:microsoft:word:2016", "cpe:2.3:a:microsoft:word"):
        assert row(broken) == ("", "", "", "", "")


def test_parse_cpe_with_escaped_colon(evaluate):
    name = "cpe:2.3:a:acme:a\\:b:1:*:*:*:*:*:*:*"
    assert evaluate(products.parse_cpe, [name])[0]["vendor"] == ""
    assert evaluate(lambda c: products.parse_cpe(c, escaped=True), [name])[0]["product"] == "a\\:b"


CONFIGURATIONS = "array<struct<nodes:array<struct<cpeMatch:array<struct<criteria:string>>>>>>"


def test_first_cpe(evaluate):
    def config(*criteria):
        return ([([(c,) for c in criteria],)],)

    cases = [
        (None, None),
        ([], None),
        ([(None,)], None),
        ([([(None,)],)], None),
        ([config("cpe:2.2:old", f" {WORD}")], WORD),
        ([(None,), ([(None,), ([("x",)],)],), config(WORD)], WORD),
    ]
    assert evaluate(products.first_cpe, [c for c, _ in cases], CONFIGURATIONS) == [e for _, e in cases]


def test_uuid4(evaluate):
    u4, u1 = str(uuid.uuid4()), str(uuid.uuid1())
    values = [u4, u1, u4.replace("-", ""), "{" + u4 + "}", "urn:uuid:" + u4, u4.upper(), "no", None, u4 + "0"]
    assert evaluate(ids.is_uuid4, values) == [True, False, True, True, True, True, False, False, False]
    assert evaluate(ids.is_uuid, values) == [True, True, True, True, True, True, False, False, False]


def test_name_uuid4_is_a_uuid4(evaluate):
    made = evaluate(ids.name_uuid4, ["a", "b", "a"])
    assert made[0] == made[2] != made[1]
    assert all(uuid.UUID(m).version == 4 for m in made)


ISO = [
    # text, is naive ISO, is ISO with offset
    ("2026-08-25T00:00:00.000", True, False),
    ("2026-08-25", True, False),
    ("20260825", True, False),
    ("20260825T101112", True, False),
    ("2026-W35-2", True, False),
    ("2026-08-25 10:11", True, False),
    ("2026-08-25T10:11:12Z", False, True),
    ("2026-08-25T10:11:12.123456+05:30", False, True),
    ("2026-08-25T10+00", False, True),
    ("20260825T101112.5+0530", False, True),
    (" 2026-08-25T10:11:12Z ", False, True),
    ("2026-02-30T10:11:12Z", False, False),
    ("2026-13-01", False, False),
    ("2026-08-25T25:00:00Z", False, False),
    ("2026-08-25T10:61:00Z", False, False),
    ("2026-08-25T10:11:12+24:00", False, False),
    ("2026-08-25T10:11:12 Z", False, False),
    ("yesterday", False, False),
    ("", False, False),
    (None, False, False),
]


def test_iso_forms(evaluate):
    values = [v for v, _, _ in ISO]
    assert evaluate(dates.is_iso8601, values) == [aware for _, _, aware in ISO]
    expected = [v.strip() + "+00:00" if naive else v.strip() if aware else v for v, naive, aware in ISO]
    assert evaluate(dates.with_offset, values) == expected


def test_instants_do_not_depend_on_the_session_zone(spark, evaluate):
    values = ["2026-01-15T10:00:00.000", "2026-01-15T10:00:00Z", "2026-01-15T12:00:00+02:00", "bad", None]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for other in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", other)
            assert evaluate(lambda c: F.unix_seconds(dates.to_instant(c)), values) == [1768471200] * 3 + [None] * 2
            assert evaluate(lambda c: dates.to_ntz(c).cast("string"), values[:3]) == ["2026-01-15 10:00:00"] * 3
            assert evaluate(lambda c: dates.iso_text(dates.to_instant(c)), values[:1]) == ["2026-01-15T10:00:00.000000+00:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_bad_date_is_null(evaluate):
    assert [str(d) for d in evaluate(dates.to_day, ["2026-01-15T10:00:00.000", "2026-02-30", "x", None])] == [
        "2026-01-15", "None", "None", "None"
    ]


def test_redact_uri(evaluate):
    cases = {
        "store://user:secret@Host:27017/db?x=1": "store://host:27017",
        "https://h.example/path@x": "https://h.example",
        "https://a@b@h.example:080/": "https://h.example:80",
        "http://h:0/": "http://h",
        "http://[::1]:80/": "http://::1:80",
    }
    assert evaluate(uris.redact_uri, list(cases)) == list(cases.values())


def test_surrogate_key_hashes_null(evaluate):
    keys = evaluate(ids.surrogate_key, [None, "UNKNOWN", "x"])
    assert None not in keys and len(set(keys)) == 3


def test_null_markers(evaluate):
    assert evaluate(text.null_markers, ["", "NaN", " NULL ", "null", "Null", " x ", None]) == [None, None, None, None, "Null", "x", None]
