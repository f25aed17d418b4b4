"""Dedupe, quality, windows, star schema, loading and reconciliation."""

import random
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from vulnlake.functions.ids import surrogate_key
from vulnlake.operators import coverage, dedupe, incremental, marts, quality, reconcile, runlog, star, windows
from vulnlake.schemas import CLEANED_SCHEMA, WAREHOUSE_SCHEMA
from vulnlake.sources import cleaned, tables
from vulnlake.sources.tables import align_to_schema

# ---------------------------------------------------------------- dedupe


def brute_latest(rows):
    best = {}
    for key, version, tie in rows:
        rank = (version is not None, version or "", tie)
        if key not in best or rank > best[key][0]:
            best[key] = (rank, (key, version, tie))
    return sorted((v for _, v in best.values()), key=str)


def test_latest_wins_with_a_hot_key_matches_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        key = "hot" if rng.random() < 0.4 else f"k{rng.randrange(200)}"
        version = None if rng.random() < 0.1 else f"2026-01-{rng.randrange(1, 29):02d}T00:00:00"
        rows.append((key, version, i))
    for parts in (1, 7):
        df = spark.createDataFrame(rows, "id string, v string, tie int").repartition(parts)
        got = dedupe.latest_wins(df, "id", F.col("v"), [F.col("tie")]).collect()
        assert sorted((tuple(r) for r in got), key=str) == brute_latest(rows)


def test_latest_records_compares_instants_and_is_repeatable(spark):
    rows = [
        ("a", "2026-01-01T12:00:00+05:00", "early"),  # 07:00 UTC, though its text sorts last
        ("a", "2026-01-01T10:00:00.000", "late"),
        ("b", "2026-01-01T10:00:00.000", "x"),
        ("b", "2026-01-01T10:00:00.000", "y"),
        ("c", None, "none"),
        ("c", "bad", "text"),
    ]
    results = set()
    for parts in (1, 3, 6):
        df = spark.createDataFrame(rows, "cve_id string, last_modified string, note string").repartition(parts)
        results.add(tuple(sorted((r["cve_id"], r["note"]) for r in dedupe.latest_records(df).collect())))
    assert len(results) == 1
    got = dict(results.pop())
    assert got["a"] == "late" and got["c"] == "text"


def test_batch_dedupe_keeps_all_null_ids(spark):
    rows = [("e1", 0, 5), ("e1", 0, 2), (None, 0, 1), (None, 0, 3), ("e2", 1, 1)]
    df = spark.createDataFrame(rows, "event_id string, p int, o int")
    kept = dedupe.batch_dedupe(df, "event_id", [F.col("p"), F.col("o")])
    assert sorted(tuple(r) for r in kept.filter("event_id is not null").collect()) == [("e1", 0, 2), ("e2", 1, 1)]
    assert kept.filter("event_id is null").count() == 2
    assert dedupe.duplicate_count(df, "event_id").first()["duplicates"] == 1
    assert dedupe.duplicate_count(df.filter("p = 9"), "event_id").first()["duplicates"] == 0


def test_duplicate_ids(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,), (None,), ("c",), ("c",)], "cve_id string")
    assert [tuple(r) for r in dedupe.duplicate_ids(df, "cve_id").collect()] == [("b", 2), ("c", 2)]


def test_insert_if_absent(spark):
    new = spark.createDataFrame([("a", 2), ("a", 1), ("b", 1), ("c", 1)], "id string, o int")
    stored = spark.createDataFrame([("b", 0), ("z", 0)], "id string, o int")
    got = dedupe.insert_if_absent(new, stored, "id", [F.col("o")])
    assert sorted(tuple(r) for r in got.collect()) == [("a", 1), ("c", 1)]


def test_upsert_latest(spark):
    schema = "id string, v int, note string"
    base = spark.createDataFrame([("a", 1, "old"), ("b", 5, "kept"), ("c", 1, "untouched")], schema)
    inc = spark.createDataFrame([("a", 2, "new"), ("b", 4, "stale"), ("d", 1, "first"), ("d", 2, "second")], schema)
    got = dedupe.upsert_latest(base, inc, "id", F.col("v"), [F.col("note")])
    assert {r["id"]: r["note"] for r in got.collect()} == {"a": "new", "b": "kept", "c": "untouched", "d": "second"}
    assert got.count() == 4


def test_ties_do_not_depend_on_the_day_of_the_run(spark):
    rows = [(f"k{i % 50}", "2024-01-01", f"note {i}", i) for i in range(200)]

    def winners(shift):
        df = spark.createDataFrame([(*r[:3], r[3] * 7 % 11 + shift) for r in rows], "cve_id string, last_modified string, note string, days_since_published int")
        return {r["cve_id"]: r["note"] for r in dedupe.latest_records(df).collect()}

    assert winners(1) == winners(2)


def test_merge_keeps_ids_without_a_year(spark, tmp_path):
    base = str(tmp_path / "base")
    incremental.init_base(spark, base)
    for odd in ("odd-1", "odd-2"):
        rows = spark.createDataFrame([(odd, "2024-01-01T00:00:00")], "cve_id string, last_modified string")
        incremental.merge_increment(spark, base, align_to_schema(rows, CLEANED_SCHEMA))
    assert sorted(r["cve_id"] for r in incremental.scan_base(spark, base).collect()) == ["odd-1", "odd-2"]


def test_slices_agree_on_records_and_on_bronze(spark):
    days = ["2026-02-28T10:00", "2026-02-31T10:00", "2026-03-01", "2026-01-31T23:59:59.999", "2026-02-01", "soon", None, "2025-02-10", "2026-02"]
    raw = spark.createDataFrame([(d,) for d in days], "published string")
    bronze = raw.withColumn("pub_year", F.year(F.substring("published", 1, 10).try_cast("date")))
    got = [sorted(r["published"] for r in windows.slice_window(df, date(2026, 2, 1), date(2026, 2, 28)).collect()) for df in (raw, bronze)]
    assert got[0] == got[1] == ["2026-02-01", "2026-02-28T10:00"]
    odd = [windows.slice_window(df, date(2026, 2, 1), date(2026, 3, 15)).where("published like '2026-02-31%'").count() for df in (raw, bronze)]
    assert odd == [1, 1]


# ---------------------------------------------------------------- quality


def buckets(df):
    return {r[0]: r[1] for r in df.collect()}


def test_buckets_are_zero_filled_and_trimmed(spark):
    rows = [("affected", "vendor_direct", " High "), (" affected ", " vendor_direct ", "high"), ("cpe_fallback", "odd", "MEGA"),
            (None, None, None), ("", "", ""), ("unresolved", "cert_national", "NONE")]
    df = spark.createDataFrame(rows, "vendor_source string, cve_source_type string, severity string")
    assert buckets(quality.vendor_resolution(df)) == {
        "resolved_via_affected": 2, "resolved_via_cpe_fallback": 1, "still_unresolved": 3}
    assert buckets(quality.source_types(df)) == {"vendor_direct": 2, "third_party_db": 0, "cert_national": 1, "other": 3}
    assert buckets(quality.severity_buckets(df)) == {"NONE": 1, "LOW": 0, "MEDIUM": 0, "HIGH": 2, "CRITICAL": 0, "null": 3}
    assert buckets(quality.severity_buckets(df.filter("false")))["null"] == 0


def test_run_counts(spark):
    rows = [("CVE-2026-1", 1, 5.0, "d", "v"), ("CVE-2026-1", 2, None, " ", None), ("CVE-2026-2", 1, 1.0, "d", "\t"),
            ("bad", 1, None, None, None), (None, 1, None, None, None)]
    df = spark.createDataFrame(rows, "cve_id string, m int, cvss_score double, description_en string, vendor string")
    got = quality.run_counts(df, F.col("m"), []).first().asDict()
    assert list(got.values()) == [5, 2, 1, 2, 1, 1, 2]
    assert list(quality.run_counts(df.filter("false"), F.col("m"), []).first()) == [0] * 7


# ---------------------------------------------------------------- windows


def test_resolve_window():
    day = date(2026, 9, 21)
    assert windows.resolve_window(None, None, day) == (date(2026, 9, 15), day)
    assert windows.resolve_window(day, day, day) == (day, day)
    with pytest.raises(ValueError):
        windows.resolve_window(day, None, day)
    with pytest.raises(ValueError):
        windows.resolve_window(day, date(2026, 1, 1), day)


def test_split_range_covers_without_overlap():
    chunks = windows.split_range(date(2026, 1, 1), date(2026, 12, 31), 120)
    assert [c[0].isoformat() for c in chunks] == ["2026-01-01", "2026-05-01", "2026-08-29", "2026-12-27"]
    assert chunks[-1][1] == date(2026, 12, 31)
    for a, b in zip(chunks, chunks[1:]):
        assert (b[0] - a[1]).days == 1


def test_year_windows():
    got = windows.year_windows(date(2026, 9, 21), 2)
    assert [windows.window_label(w) for w in got] == ["2024-09-22..2025-09-21", "2025-09-22..2026-09-21"]
    assert windows.year_windows(date(2024, 2, 29), 2) == [
        (date(2022, 3, 1), date(2023, 2, 28)), (date(2023, 3, 1), date(2024, 2, 29))]


PUBLISHED = [("a", "2026-01-01", 5.0, "v"), ("a", "2026-01-02", None, ""), ("b", "2025-12-31", None, None),
             ("c", None, None, "v"), ("d", "2020-01-01", 1.0, "v")]


def published(spark):
    df = spark.createDataFrame(PUBLISHED, "cve_id string, d string, cvss_score double, vendor string")
    return df.withColumn("published_date", F.col("d").cast("date"))


def test_pub_windows_count_all_rows(spark):
    got = {r[0]: tuple(r)[1:] for r in windows.pub_windows(published(spark), windows.year_windows(date(2026, 9, 21), 2)).collect()}
    assert got == {"2025-09-22..2026-09-21": (2, 2, 2), "OUTSIDE": (2, 1, 0)}


def test_window_breakdown_counts_first_rows(spark):
    bounds = windows.year_windows(date(2026, 9, 21), 2)
    got = {r[0]: tuple(r)[1:] for r in windows.window_breakdown(published(spark), bounds, [F.col("d")]).collect()}
    assert got == {"2024-09-22..2025-09-21": (0, 0, 0, None, None), "2025-09-22..2026-09-21": (2, 1, 1, 50.0, 50.0),
                   "OUTSIDE": (2, 0, 0, None, None)}


def test_chunk_coverage(spark):
    got = windows.chunk_coverage(published(spark), "published_date", date(2025, 12, 1), date(2026, 1, 31), 31)
    assert {(str(r["chunk_start"]), r["records"]) for r in got.collect()} == {("2025-12-01", 1), ("2026-01-01", 2), ("None", 2)}


def test_modified_slice_is_half_open(spark):
    rows = [("a", "2026-01-01T00:00:00.000"), ("b", "2026-01-02T00:00:00.000"), ("c", None), ("d", "2026-01-01T23:59:59.999")]
    df = spark.createDataFrame(rows, "id string, lastModified string")
    bounds = [F.lit(datetime(2026, 1, d, tzinfo=timezone.utc)) for d in (1, 2)]
    assert sorted(r["id"] for r in windows.slice_modified(df, *bounds).collect()) == ["a", "d"]


def test_metric_coverage(spark):
    metric = "array<struct<cvssData:struct<baseScore:double>>>"
    blocks = ["cvssMetricV31", "cvssMetricV30", "cvssMetricV2", "cvssMetricV40"]
    schema = f"id string, published string, lastModified string, metrics struct<{','.join(f'{b}:{metric}' for b in blocks)}>"
    some, none = [((7.0,),)], [((None,),)]
    rows = [
        ("a", "2026-01-05T00", "1", (None, None, None, some)),
        ("a", "2026-01-05T00", "2", (some, None, None, None)),
        ("b", "2026-01-06T00", "1", (none, [], None, some)),
        ("c", "2026-01-31T23", "1", None),
        ("d", "2026-02-01T00", "1", None),
        ("e", None, "1", None),
    ]
    got = coverage.metric_coverage(spark.createDataFrame(rows, schema), date(2026, 1, 1), date(2026, 1, 31)).first()
    assert tuple(got)[1:] == (3, 2, 1, 1, 66.67, 33.33, 33.33)
    empty = coverage.metric_coverage(spark.createDataFrame([], schema), date(2026, 1, 1), date(2026, 1, 31)).first()
    assert tuple(empty)[1:] == (0, 0, 0, 0, 0.0, 0.0, 0.0)


# ---------------------------------------------------------------- star schema and marts


def loaded(spark):
    rows = [("CVE-2026-1", "acme", "w", "HIGH", "2026-01-01", 7.0), ("CVE-2026-2", "", None, None, "2026-01-02", None),
            ("CVE-2026-2", None, "", "", None, None), ("CVE-2026-3", " ", "w", "high", "2026-01-01", 7.0)]
    df = spark.createDataFrame(rows, "cve_id string, vendor string, product string, severity string, d string, cvss_score double")
    day = F.col("d").cast("date")
    return df.withColumns({"published_date": day, "year": F.year(day), "month": F.month(day), "quarter": F.quarter(day),
                           "severity_rank": F.lit(1), "days_since_published": F.lit(1), "cvss_version": F.lit(None).cast("string")})


def test_star_keeps_every_fact(spark):
    df = loaded(spark)
    for key in (surrogate_key,):
        facts, dims = star.build_star(df, key)
        assert {r["vendor"] for r in dims["vendor"].collect()} == {"acme", " ", "UNKNOWN"}
        assert {r["severity"] for r in dims["severity"].collect()} == {"HIGH", "high", "MISSING"}
        assert dims["date"].count() == 3
        assert star.star_join(facts, dims).count() == df.count()
        for name, dim in dims.items():
            assert star.orphan_keys(facts, dim, f"{name}_key").count() == 0
        assert star.orphan_keys(facts, dims["vendor"].filter("vendor <> 'UNKNOWN'"), "vendor_key").count() == 1


def test_sentinel_appears_once(spark):
    df = spark.createDataFrame([("UNKNOWN",), ("UNKNOWN",)], "vendor string")
    assert star.dim_from(df, "vendor").count() == 1


def test_marts(spark):
    df = loaded(spark)
    assert {tuple(r) for r in marts.severity_share(df).collect()} == {("MISSING", 2, 50.0), ("HIGH", 1, 25.0), ("high", 1, 25.0)}
    assert tuple(marts.data_quality(df).first()) == (4, 3, 1, 2, 2, 2)
    assert {tuple(r) for r in marts.vendor_counts(df).collect()} == {("acme", 1, 1), (" ", 1, 1)}
    assert [r["vendor"] for r in marts.top_vendors(df, 1).collect()] == [" "]
    assert [tuple(r) for r in marts.version_counts(df).collect()] == [("NONE", 4)]
    monthly = {(r["year"], r["month"]): tuple(r)[2:] for r in marts.monthly_overview(df).collect()}
    assert monthly == {(2026, 1): (3, 1, 0, 1), (None, None): (1, 0, 0, 1)}


# ---------------------------------------------------------------- loading


def cleaned_rows(spark, n=3):
    df = spark.range(n).select(F.concat(F.lit("CVE-2026-"), F.col("id").cast("string")).alias("cve_id"),
                               F.lit("2026-01-15T10:00:00.000").alias("published"), F.lit('a "q",\nb').alias("description_en"),
                               F.lit(7.5).alias("cvss_score"), F.lit("").alias("vendor"))
    return tables.align_to_schema(df, CLEANED_SCHEMA)


def test_table_load_append_clone_and_align(spark):
    tables.create_database(spark, "stage_test")
    name, copy = "stage_test.cleaned", "stage_test.cleaned_copy"
    tables.create_table(spark, name, replace=True)
    assert spark.table(name).schema["published"].dataType.typeName() == "timestamp_ntz"
    df = cleaned_rows(spark)
    assert tables.load_table(df, name) == 3
    assert tables.load_table(df, name) == 3
    assert tables.load_table(df, name, full_reload=False) == 6
    assert tuple(marts.load_dups(spark.table(name)).first()) == (6, 3, 3)
    assert str(spark.table(name).first()["published"]) == "2026-01-15 10:00:00"
    spark.sql(f"DROP TABLE IF EXISTS {copy}")
    tables.clone_table(spark, copy, name)
    assert spark.table(copy).count() == 0 and len(tables.describe_schema(spark.table(copy)).collect()) == 26
    spark.sql("DROP TABLE IF EXISTS stage_test.narrow")
    spark.sql("CREATE TABLE stage_test.narrow (CVE_ID string) USING parquet")
    with pytest.raises(ValueError, match="missing from the target"):
        tables.load_table(df, "stage_test.narrow")
    assert len(tables.add_missing_columns(spark, "stage_test.narrow", WAREHOUSE_SCHEMA)) == 25
    assert tables.add_missing_columns(spark, "stage_test.narrow", WAREHOUSE_SCHEMA) == []
    assert tables.load_table(df, "stage_test.narrow") == 3


def test_align_reports_both_sides(spark):
    df = spark.createDataFrame([("a", 1)], "CVE_ID string, extra int")
    diff = tables.schema_diff(df, CLEANED_SCHEMA)
    assert diff.unmatched == ["extra"] and len(diff.absent) == 25
    got = tables.align_to_schema(df, CLEANED_SCHEMA, strict=False)
    assert got.columns == CLEANED_SCHEMA.fieldNames() and got.first()["cve_id"] == "a"


def test_csv_round_trip(spark, tmp_path):
    df = cleaned_rows(spark)
    path = str(tmp_path / "csv")
    cleaned.write_csv(df, path, single=True)
    back = cleaned.scan_cleaned_csv(spark, path)
    assert back.schema == CLEANED_SCHEMA
    assert {(r["cve_id"], r["description_en"], r["cvss_score"]) for r in back.collect()} == {
        (f"CVE-2026-{i}", 'a "q",\nb', 7.5) for i in range(3)}
    assert cleaned.scan_cleaned_csv(spark, path, typed=False, apply_null_markers=True).first()["vendor"] is None


def test_reconcile(spark):
    a = spark.createDataFrame([("rows", 3), ("missing", 1), ("only_a", 1)], "metric string, value bigint")
    b = spark.createDataFrame([("rows", 3), ("missing", 2), ("only_b", None)], "metric string, value bigint")
    got = {r["metric"]: r["matches"] for r in reconcile.reconcile(a, b).collect()}
    assert got == {"rows": True, "missing": False, "only_a": False, "only_b": False}
    x = spark.createDataFrame([(1,), (1,), (2,)], "v int")
    y = spark.createDataFrame([(1,), (3,)], "v int")
    assert sorted(tuple(r) for r in reconcile.reconcile_rows(x, y).collect()) == [(1, "left"), (2, "left"), (3, "right")]


# ---------------------------------------------------------------- runs


def test_run_stats_and_throughput(spark):
    df = spark.createDataFrame([("a", 27.5, 100), ("a", 26.7, 100), ("b", 3.0, 0), ("c", 0.0, 5), ("c", None, 5), ("d", 2.0, None)],
                               "label string, duration_s double, records bigint")
    stats = {r["label"]: tuple(r)[1:] for r in runlog.run_stats(df).collect()}
    assert stats["a"] == (2, 27.1, 26.7, 27.5, 0.8, 0.6) and stats["b"][-1] is None
    rate = [(r["label"], r["throughput_per_second"]) for r in runlog.run_throughput(df).collect()]
    assert rate == [("a", 3.6), ("a", 3.7), ("b", None), ("c", None), ("c", None), ("d", None)]


def test_log_summary(spark):
    lines = ['{"sent": 1, "skipped": 0}', "plain", '{"sent": 2}', ' {"skipped": null, "sent": 3, "x": {}} ', '{"sent": 4, "skipped": }', '["sent", "skipped"]']
    df = spark.createDataFrame(list(enumerate(lines)), "line_no int, text string").repartition(3)
    got = runlog.log_summary(df, ["sent", "skipped"]).collect()
    assert [tuple(r) for r in got] == [(3, '{"skipped": null, "sent": 3, "x": {}}')]
    assert runlog.log_summary(df, ["absent"]).count() == 0


# ---------------------------------------------------------------- high-water mark


def test_marks_and_asked_windows(spark, tmp_path):
    now = datetime(2026, 10, 12, 6, tzinfo=timezone.utc)
    path = str(tmp_path / "control")
    incremental.init_control(spark, path)
    assert incremental.high_water(spark, path) is None
    handled = spark.createDataFrame([("b7", "v1"), ("b8", "v1")], "landed string, version string")
    incremental.advance(spark, path, now, handled)
    incremental.advance(spark, path, datetime(2026, 10, 1))
    incremental.init_control(spark, path)
    assert incremental.high_water(spark, path) == now
    rows = incremental.scan_control(spark, path).collect()
    assert {(r["landed"], r["version"]) for r in rows if r["landed"]} == {("b7", "v1"), ("b8", "v1")}
    with pytest.raises(TypeError, match="table"):
        incremental.advance(spark, path, now, "b7")
    assert incremental.asked_window(None, None, now)[1] == now
    assert incremental.asked_window(datetime(2026, 1, 1), now, now)[0].year == 2026
    with pytest.raises(ValueError):
        incremental.asked_window(now, datetime(2026, 1, 1), now)
