"""What the stored queries move and keep: compact feed files and bronze, and the sort of a landing."""

import gzip
from datetime import date, datetime

from pyspark.sql import functions as F

from vulnlake.functions.sources import source_type
from vulnlake.functions.text import is_blank
from vulnlake.functions.ids import is_valid_id
from vulnlake.operators import dedupe, incremental
from vulnlake.operators.flatten import transform
from vulnlake.plans import jobs, queries, stored
from vulnlake.plans import records as R
from vulnlake.schemas import CLEANED_SCHEMA, EVENT_COLUMNS, RAW_COLUMN, RECORD_SCHEMA
from vulnlake.sources import feed
from vulnlake.sources.tables import align_to_schema
from vulnlake.streaming import jobs as streams
from vulnlake.streaming import routing

FLAT = (
    "cve_id string, published date, last_modified date, order_no bigint, line_no bigint, part_no bigint, supp_no bigint, price double, "
    "cvss_score double, severity string, cvss_version string, vendor string, product string, source_identifier string"
)


def flat(spark, n=1200):
    day = date(1997, 3, 1)
    rows = [(f"CVE-1997-{k}", day, day, k, k % 3, k % 50, k % 7, 1.5, k % 90 / 10, "HIGH", "3.1", f"v{k % 9}", f"p {k % 50}", "cve@mitre.org") for k in range(n)]
    return spark.createDataFrame([*rows, rows[5], rows[5]], FLAT)


def test_feed_files_are_compressed_and_whole(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stored.R, "records", lambda *_: flat(spark))
    paths = stored.written_feed(spark, "", str(tmp_path / "feed"))
    envelopes = feed.assert_envelope(feed.scan_feed(spark, paths))
    assert sorted(r[0] for r in envelopes.select("totalResults").collect()) == [200, 500, 502]
    records = feed.explode_records(envelopes)
    assert records.count() == 1202 and records.filter("id = 'CVE-1997-5'").count() == 3
    text = records.agg(F.sum(F.length(RAW_COLUMN))).first()[0]
    assert sum(f.stat().st_size for f in (tmp_path / "feed").rglob("*.gz")) < text / 4


def test_text_alone_lands_as_parsed_records_do(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stored.R, "records", lambda *_: flat(spark))
    rows = stored.tagged(spark, "")
    feed.land_bronze(stored.as_text(rows).select(RAW_COLUMN), str(tmp_path / "a"), cluster=True)
    feed.land_bronze(stored.parsed(rows).drop(*[c for c in rows.columns if c.startswith("_")]), str(tmp_path / "b"), cluster=True)
    a, b = feed.scan_bronze(spark, str(tmp_path / "a")).drop("landed", "version"), feed.scan_bronze(spark, str(tmp_path / "b")).drop("landed", "version")
    assert a.count() == 1202 and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_a_merge_deals_a_large_folder_over_tasks(spark, tmp_path):
    rows = [(f"CVE-2024-{n}", "2026-01-01T00:00:00", f"text {n}") for n in range(400)]
    cleaned = align_to_schema(spark.createDataFrame(rows, "cve_id string, last_modified string, description_en string"), CLEANED_SCHEMA)
    incremental.init_base(spark, str(tmp_path / "base"), buckets=1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        incremental.merge_increment(spark, str(tmp_path / "base"), cleaned)
        incremental.merge_increment(spark, str(tmp_path / "base"), cleaned.withColumn("last_modified", F.lit("2026-02-01T00:00:00")))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    base = incremental.scan_base(spark, str(tmp_path / "base"), F.lit(date(2026, 3, 1)))
    assert base.count() == 400 and base.filter("last_modified LIKE '2026-02%'").select("cve_id").distinct().count() == 400
    assert all(len(list(f.glob("*.parquet"))) > 1 for f in (tmp_path / "base").glob("version=*/id_year=2024/bucket=0"))


def test_source_types_and_blanks_without_patterns_and_trims(spark):
    texts = [None, "", "   ", " ", " a", "~", "\x7f", "a", "desk@x.gov", " desk@x.GOV.UK ", "gov", "x.gov.us", "my-CERT@x.de", "secure@cisco.com", "é"]
    df = spark.createDataFrame([(t,) for t in texts], "v string").select(source_type(F.col("v")).alias("t"), is_blank(F.col("v")).alias("b"))
    assert [r["b"] for r in df.collect()] == [True] * 4 + [False] * 11
    national = {"desk@x.gov", " desk@x.GOV.UK ", "my-CERT@x.de"}
    assert [r["t"] == "cert_national" for r in df.collect()] == [t in national for t in texts]
    assert "RLIKE" not in df._jdf.queryExecution().optimizedPlan().toString().upper()


def test_events_of_one_row_group_are_built_by_several_tasks(spark, tmp_path):
    day = datetime(2024, 1, 2, 3, 4, 5)
    rows = [(n, day, n % 9, "error", 1.0, "{}") for n in range(60)]
    df = spark.createDataFrame(rows, "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string")
    df.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    messages = R.messages(spark, str(tmp_path)).withColumn("task", F.spark_partition_id()).collect()
    assert len({r["task"] for r in messages}) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    first = [("events", n % 4, 2 * n, n) for n in range(60)]
    again = [("events", 0 if n % 2 else n % 4, 2 * n + 1, n) for n in range(0, 60, 3)]
    assert sorted((r["topic"], r["partition"], r["offset"], r["n"]) for r in messages) == sorted(first + again)


def versioned(spark, tmp_path):
    """Flat rows of few ids: several versions each, ties that differ in content, whole copies, malformed and absent ids."""
    ids = ["CVE-1997-1", "CVE-1997-2", "CVE-1997-3", "CVE-97-4", None]
    rows = [
        (ids[k % 5], date(1997, 3, 1), date(1997, 3, 1 + k % 4) if k % 5 != 2 else None, k, k % 3, k % 50, k % 7, 1.5, k % 90 / 10, "HIGH", "3.1", f"v{k % 9}", f"p {k % 50}", "cve@mitre.org")
        for k in range(200)
    ]
    spark.createDataFrame([*rows, *rows[:9]], FLAT).write.parquet(str(tmp_path / "flat"))
    return R.nest(spark.read.schema(FLAT).parquet(str(tmp_path / "flat")))


def test_only_records_of_the_newest_version_are_built(spark, tmp_path):
    records = versioned(spark, tmp_path)
    dedupe.newest_versions(records, "id", "lastModified").write.parquet(str(tmp_path / "versions"))
    versions = spark.read.parquet(str(tmp_path / "versions"))
    assert {(r["_key"], r["_version"] and r["_version"].day, r["_rows"]) for r in versions.collect()} == {
        ("CVE-1997-1", 4, 42), ("CVE-1997-2", 4, 42), ("CVE-1997-3", None, 42), (None, 4, 83),
    }
    newest = dedupe.newest_only(records, versions, "id", "lastModified")
    assert {r["id"]: r["n"] for r in newest.groupBy("id").agg(F.count("*").alias("n")).collect()}["CVE-1997-3"] == 42  # no version can be read: all stay
    assert {r[0][:10] for r in newest.filter("id != 'CVE-1997-3'").select("lastModified").collect()} == {"1997-03-04"}
    # The filter sinks below the projection that nests a record.
    plan = transform(newest, F.lit(date(2002, 1, 1)))._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and "cvssMetricV31" not in plan[plan.index("LeftSemi") :] and "cpe:2.3:a:" not in plan[plan.index("LeftSemi") :]


def test_the_cleaned_layer_is_that_of_all_records(spark, tmp_path):
    records, as_of = versioned(spark, tmp_path), F.lit(date(2002, 1, 1))
    report = jobs.clean_records(spark, records, str(tmp_path / "out"), as_of, csv=False)
    assert (report["input_records"], report["records_dropped_invalid_cve_id"], report["output_records"], report["duplicate_records_removed"]) == (209, 83, 3, 123)
    whole = dedupe.latest_records(transform(records.filter(is_valid_id(F.col("id"))), as_of)).drop("vendor_source")
    out = spark.read.parquet(str(tmp_path / "out/cleaned.parquet")).select(*whole.columns)
    assert out.count() == 3 and out.exceptAll(whole).isEmpty() and whole.exceptAll(out).isEmpty()
    empty = jobs.clean_records(spark, records.limit(0), str(tmp_path / "none"), as_of, csv=False)
    assert (empty["input_records"], empty["output_records"], empty["duplicate_records_removed"]) == (0, 0, 0)


def test_row_reconcile_deals_ids_over_parts_that_grow_with_the_table(spark, monkeypatch):
    folder = "/root/testdata/sf0.001"
    few = queries.q_row_reconcile(spark, folder)
    monkeypatch.setattr(R, "ROWS_PER_PART", 500)
    many, parts = queries.q_row_reconcile(spark, folder), -(-R.table(spark, folder, "lineitem").count() // 500)
    assert parts > 4 and f", {parts})" in many._jdf.queryExecution().optimizedPlan().toString() + many._jdf.queryExecution().executedPlan().toString()
    assert few.count() > 0 and few.exceptAll(many).isEmpty() and many.exceptAll(few).isEmpty()


def event_table(spark, tmp_path, n=240):
    day = datetime(2024, 1, 2, 3, 4, 5)
    rows = [(k, day, k % 9, "error", 1.0, "{}") for k in range(n)]
    df = spark.createDataFrame(rows, "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string")
    df.write.parquet(str(tmp_path / "events.parquet"))


def test_messages_are_moved_and_kept_as_their_text(spark, tmp_path):
    event_table(spark, tmp_path)
    folder = tmp_path / "stream"
    stored.sent(spark, str(tmp_path), f"{folder}/in", F.lit(True), "1")
    assert list(folder.rglob("*.json.gz")) and not list(folder.rglob("*.json"))
    assert not stored.consumed(spark, str(folder))
    staged = spark.read.parquet(*[str(f) for f in (folder / "sink/_staged").iterdir()])
    assert {c for c in staged.columns if c.startswith("_")} == {"_event_id", "_place"}
    routed = routing.route(R.messages(spark, str(tmp_path)).drop("n"))
    first = dedupe.first_per(routed.filter("kind = 'valid'"), ["_event_id"], [F.col("partition"), F.col("offset")])
    columns = [*EVENT_COLUMNS, "kafka_topic", "kafka_partition", "kafka_offset"]
    expected = routing.routed_events(first).select(*columns)
    found = streams.stored_events(spark, f"{folder}/sink/events").select(*columns)
    assert found.count() > 100 and found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()
    aside = spark.read.parquet(f"{folder}/sink/quarantine").select("value", "kind", "errors")
    bad = routed.filter("kind != 'valid'").select("value", "kind", "errors")
    assert aside.count() > 10 and aside.exceptAll(bad).isEmpty() and bad.exceptAll(aside).isEmpty()


def test_typed_records_beside_their_text_are_cast_not_parsed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stored.R, "records", lambda *_: flat(spark).unionByName(spark.createDataFrame([(None,) * 14, ('CVE-1997-"9\n', None, None, 9, *[None] * 10)], FLAT)))
    for rows in (stored.tagged(spark, ""), stored.stamped(spark, "")):
        cast = stored.parsed(rows)
        assert "from_json" not in cast._jdf.queryExecution().optimizedPlan().toString()
        own = [c for c in rows.columns if c.startswith("_")]
        read = cast.select(F.from_json(RAW_COLUMN, RECORD_SCHEMA).alias("r"), RAW_COLUMN, *own).select("r.*", RAW_COLUMN, *own)
        assert cast.dtypes == read.dtypes and cast.count() == 1204
        assert cast.exceptAll(read).isEmpty() and read.exceptAll(cast).isEmpty()


def test_feed_files_are_written_at_the_fastest_level(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stored.R, "records", lambda *_: flat(spark))
    stored.written_feed(spark, "", str(tmp_path / "feed"))
    files = list((tmp_path / "feed").rglob("*.gz"))
    texts = [gzip.decompress(f.read_bytes()) for f in files]
    assert len(files) == 3 and sum(f.stat().st_size for f in files) > 1.1 * sum(len(gzip.compress(t, 6)) for t in texts)
