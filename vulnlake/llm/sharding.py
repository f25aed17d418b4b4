"""Sharding by proportional stratified interleaving.

Rows of a source are shuffled by a seeded hash and ranked; a row's fractional rank ``(rank + 1/2) / size`` says
how far into its source it stands. Sorting all rows by it interleaves the sources in proportion, so every cut of
the order has the mixture of the whole. The order is cut into shards whose counts differ by one at most
(law ``rows``).

Edge cases: a null source is a source of its own; null text has no bytes; repeated rows each get a slot of their
own; an empty table gives an empty result; only the columns named are read, so others may have any name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vulnlake.llm.common import fraction, ranked


def interleave(df: DataFrame, stratum: str, ties: list[str], shards: int, seed: str = "shard") -> DataFrame:
    """Add ``shard`` (from 0) and ``slot`` (gapless from 0 within the shard) to every row.

    ``ties`` must tell rows apart as far as that matters; its first column seeds the shuffle. Both sorts are cut
    into slices that are ranked apart, so neither a hot stratum nor the whole table has to fit in one task.
    """
    inner = ranked(df, [stratum], fraction(ties[0], seed=seed), ties, "_rank", "_size")
    share = (F.col("_rank") + 0.5) / F.col("_size")
    placed = ranked(inner, [], share, [stratum, *ties], "_place", "_rows")
    per, rest = F.floor(F.col("_rows") / shards), F.col("_rows") % shards
    wide = rest * (per + 1)
    in_wide = F.col("_place") < wide
    later = F.col("_place") - wide
    safe = F.greatest(per, F.lit(1))
    return placed.withColumns(
        {
            "shard": F.when(in_wide, F.floor(F.col("_place") / (per + 1))).otherwise(rest + F.floor(later / safe)).cast("int"),
            "slot": F.when(in_wide, F.col("_place") % (per + 1)).otherwise(later % safe).cast("long"),
        }
    ).drop("_rank", "_size", "_place", "_rows")
