"""Run logs: timing statistics, throughput, and summaries picked from log lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vulnlake.functions.text import strip


def run_stats(runs: DataFrame, label: str = "label", duration: str = "duration_s", digits: int = 1) -> DataFrame:
    """Spread of repeated runs per label; the sample deviation exists from two runs on."""
    d = F.col(duration)
    return runs.groupBy(label).agg(
        F.count(d).alias("repeats"),
        F.round(F.avg(d), digits).alias("mean_s"),
        F.min(d).alias("min_s"),
        F.max(d).alias("max_s"),
        F.round(F.max(d) - F.min(d), digits).alias("spread_s"),
        F.when(F.count(d) > 1, F.round(F.stddev_samp(d), digits)).alias("stdev_s"),
    )


def run_throughput(runs: DataFrame, duration: str = "duration_s", records: str = "records") -> DataFrame:
    """Records per second; null when either figure is null or zero."""
    d, n = F.col(duration), F.col(records)
    usable = (d > 0) & (n != 0)
    return runs.withColumn("throughput_per_second", F.when(usable, F.round(n / F.nullif(d, F.lit(0)), 1)))


def log_summary(lines: DataFrame, keys: list[str], text: str = "text", position: str = "line_no") -> DataFrame:
    """The last line that is a JSON object with all ``keys``; other lines are ignored.

    A plain aggregate: every task keeps its last match, one row is merged.
    """
    line = strip(F.col(text))
    names = F.json_object_keys(line)
    wanted = F.array_size(F.array_intersect(names, F.array(*[F.lit(k) for k in keys]))) == len(set(keys))
    is_object = line.startswith("{") & line.endswith("}") & F.try_parse_json(line).isNotNull()
    return (
        lines.filter(is_object)
        .filter(F.coalesce(wanted, F.lit(False)))
        .agg(F.max(position).alias(position), F.max_by(line, F.col(position)).alias("summary"))
        .filter(F.col("summary").isNotNull())
    )


def log_lines(spark: SparkSession, paths: str | list[str], text: str = "text") -> DataFrame:
    """Lines of log files with their place: the file, and ``line_no``, which rises along it.

    Places need no shuffle and no single task: blocks of a file are read in parallel, and the scan says where a row's
    block starts; within a block, rows are numbered as they are read. Numbers rise, but have gaps.
    """
    lines = spark.read.text(paths).select(
        F.col("value").alias(text), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_row")
    )
    # A task reads its blocks one after the other, so among the rows of one block the task's numbers rise.
    return lines.select("file", F.struct("file", "_block", "_row").alias("line_no"), text)


def summary_of_logs(spark: SparkSession, paths: str | list[str], keys: list[str]) -> DataFrame:
    """The last summary in a folder of log files: :func:`log_summary` over all lines, by file name and place."""
    return log_summary(log_lines(spark, paths), keys)
