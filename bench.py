"""Headline timings: registered queries, and the batch, replay and ingest jobs.

Prints one JSON line. BENCH_SF_DIR names the input, BENCH_CPUS the cores;
BENCH_ALL=1 times every registered query instead of the headline ones; BENCH_WORK names the work folder, which all
executors must share. The batch job and the streams run over the records of two tenths of the ids (``share_of_ids``), whole
versions of each; the other queries over all rows.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from vulnlake.plans import jobs as batch_jobs  # noqa: E402
from vulnlake.plans import records as R  # noqa: E402
from vulnlake.plans.queries import REGISTRY  # noqa: E402
from vulnlake.session import build_session  # noqa: E402
from vulnlake.streaming import jobs as stream_jobs  # noqa: E402


FILLER = 7_500
TENTHS = 2

HEADLINE = """
    latest_wins quality_counts severity_share source_types monthly_overview data_quality vendor_counts
    pub_windows window_breakdown chunk_coverage star_fact star_join star_tables star_orphans load_reconcile
    incremental_upsert feed_flatten affected_resolve metric_priority metric_coverage batch_cleaned
    event_build contract_errors event_route event_idempotent event_ledger log_summary run_stats
""".split()


def timed(work: Callable[[], object]) -> float:
    started = time.perf_counter()
    work()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "vulnlake-bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder = tempfile.mkdtemp(prefix="run-", dir=os.environ.get("BENCH_WORK"))

    spark.range(1000).selectExpr("sum(id)").collect()
    queries: dict[str, float] = {}
    names = list(REGISTRY) if os.environ.get("BENCH_ALL") else HEADLINE
    for name in names:
        query = REGISTRY[name]
        queries[name] = timed(lambda: query(spark, sf_dir).write.format("noop").mode("overwrite").save())

    # The jobs on feed files made of the same records, the files themselves not timed: envelopes of 2,000 records, each
    # filled up to the size of a real one by a field that the typed schema does not know.
    nested = R.raw_nested(spark, sf_dir)
    filler = F.transform(F.sequence(F.lit(1), F.lit(FILLER // 32)), lambda i: F.md5(F.concat_ws("|", F.col("id"), i.cast("string"))))
    record = F.struct(*[c for c in nested.columns if not c.startswith("_")], filler.alias("references"))
    each = nested.select(record.alias("cve"), F.pmod(F.xxhash64("id"), F.lit(10)).alias("part")).where(f"part < {TENTHS}")
    rows = each.count()
    files = max(1, rows // 2000)
    envelope = (
        each.withColumn("file", F.pmod(F.xxhash64("cve.id", "cve.lastModified"), F.lit(files)))
        .groupBy("file")
        .agg(F.collect_list(F.struct("cve")).alias("vulnerabilities"))
    )
    feed = f"{folder}/feed"
    envelope.repartition("file").write.partitionBy("file").json(feed)
    size = spark.read.format("binaryFile").load(f"{feed}/*/*.json").agg(F.sum("length")).first()[0] / 1e6

    work: dict[str, float] = {}
    rates: dict[str, float] = {}
    out = f"{folder}/out"
    work["batch_job"] = timed(lambda: batch_jobs.run_batch(spark, f"{feed}/*/*.json", out))
    rates["batch_job"] = round(rows / work["batch_job"], 1)

    cleaned = f"{out}/cleaned.parquet"
    sent = spark.read.parquet(cleaned).count()
    work["replay_job"] = timed(
        lambda: stream_jobs.start_replay(
            spark, cleaned, f"{folder}/broker", f"{folder}/cp1", f"{folder}/ledger"
        ).awaitTermination()
    )
    work["ingest_job"] = timed(
        lambda: stream_jobs.start_consume(spark, f"{folder}/broker", f"{folder}/sink", f"{folder}/cp2").awaitTermination()
    )
    work["redelivery_job"] = timed(
        lambda: stream_jobs.start_consume(spark, f"{folder}/broker", f"{folder}/sink", f"{folder}/cp3").awaitTermination()
    )
    for name in ("replay_job", "ingest_job", "redelivery_job"):
        rates[name] = round(sent / work[name], 1)
    queries.update(work)
    print(
        json.dumps(
            {
                "metric": "total wall time of all queries and jobs",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "records_per_second": rates,
                "megabytes_per_second": {"batch_job": round(size / work["batch_job"], 1)},
                "records": {"batch_job": rows, "events": sent},
                "share_of_ids": TENTHS / 10,
                "sf": Path(sf_dir).name,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
