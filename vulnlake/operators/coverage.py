"""Which metric versions the raw records carry, independent of what the flat layer reads."""

from __future__ import annotations

from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vulnlake.functions.metrics import has_score
from vulnlake.operators.dedupe import first_per
from vulnlake.operators.windows import slice_window

# The blocks an analysis limited to versions 2 and 3 reads.
READ_BLOCKS = ["cvssMetricV31", "cvssMetricV30", "cvssMetricV2"]
NEW_BLOCK = "cvssMetricV40"


def metric_coverage(records: DataFrame, start: date, end: date, ties: list[Column] | None = None) -> DataFrame:
    """Records per window that lack a version 2/3 score, and how many of those have a 4.0 score.

    Only an id, a version text and two flags per record reach the shuffle.
    """
    metrics = F.col("metrics")
    flagged = slice_window(records, start, end).select(
        F.col("id"),
        F.coalesce("lastModified", F.lit("")).alias("modified"),
        reduce(or_, [has_score(metrics, b) for b in READ_BLOCKS]).alias("read"),
        has_score(metrics, NEW_BLOCK).alias("v40"),
        *[t.alias(f"_t{i}") for i, t in enumerate(ties or [])],
    )
    order = [F.col("modified").desc(), *[F.col(f"_t{i}").desc_nulls_last() for i in range(len(ties or []))]]
    newest = first_per(flagged, ["id"], [*order, F.col("read").desc(), F.col("v40").desc()])
    missing = ~F.col("read")
    counts = newest.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(missing).alias("missing_cvss"),
        F.count_if(missing & F.col("v40")).alias("missing_but_has_v40"),
        F.count_if(F.col("v40")).alias("has_v40_any"),
    )

    def share(name: str) -> Column:
        part = F.round(F.col(name) * 100.0 / F.nullif(F.col("records"), F.lit(0)), 2)
        return F.coalesce(part, F.lit(0.0)).alias(f"{name}_pct")

    return counts.select(
        F.lit(f"{start.isoformat()}..{end.isoformat()}").alias("window"),
        *counts.columns,
        *[share(n) for n in ("missing_cvss", "missing_but_has_v40", "has_v40_any")],
    )
