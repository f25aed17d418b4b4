"""Preference formatting: one prompt, two masked completions.

The turns of a chosen and a rejected conversation are compared place by place; their longest common prefix is the
prompt and is rendered once, what follows on either side is that side's completion. In completions only what the
assistant says is trained on: the mask is given as character spans.

The result is a row per rendered turn with its place in the part it belongs to, so a conversation of any length is
never gathered in one task; ``assembled`` joins the turns of a part to one string where a caller wants that.
Places and offsets are sums over blocks of ``BLOCK`` turns plus a sum within the block.

Edge cases: null text and roles count as empty; turns with equal or no number follow each other by role and text;
a pair whose sides are equal has two empty completions, one that lacks a side has an empty prompt; rows without a
pair id are left out, as they belong to no pair; repeated rows are turns of their own; an empty table gives an empty
result. Template marks within texts stay as they are: the spans, not the marks, say where a turn ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 1024
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
TRAINED_ROLE = "assistant"


def running(df: DataFrame, keys: list[str], block: Column, order: list[str], value: Column, into: str) -> DataFrame:
    """Sum of ``value`` over all rows before this one of the same ``keys``, by block and then ``order``."""
    rows = df.withColumns({"_block": block, "_value": value})
    sums = rows.groupBy(*keys, "_block").agg(F.sum("_value").alias("_sum"))
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    inside = Window.partitionBy(*keys, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    return rows.join(sums, [*keys, "_block"]).withColumn(into, F.col("_before") + F.col("_inside")).drop("_block", "_value", "_before", "_inside")


def turns(df: DataFrame, side: str) -> DataFrame:
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    return df.where(F.col("pair_id").isNotNull()).select(
        "pair_id", F.lit(side).alias("side"), F.coalesce("turn", F.lit(-1)).cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text")
    )


def formatted(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """Rendered turns of all pairs; both tables have ``pair_id``, ``turn``, ``role``, ``text``.

    Columns: ``pair_id``, ``part`` (prompt, chosen, rejected), ``seq`` in the part, ``role``, ``segment``, ``start`` and
    ``end`` in the part's characters, and ``trained_start``, ``trained_end`` (null where nothing is trained on).
    """
    both = turns(chosen, "chosen").union(turns(rejected, "rejected"))
    placed = running(both, ["pair_id", "side"], F.floor(F.col("turn") / BLOCK), ["turn", "role", "text"], F.lit(1), "place")
    said = F.struct("role", "text")
    met = placed.groupBy("pair_id", "place").agg(F.count(F.lit(1)).alias("n"), F.min(said).alias("low"), F.max(said).alias("high"))
    same = (F.col("n") == 2) & (F.col("low") == F.col("high"))
    shared = met.groupBy("pair_id").agg(F.coalesce(F.min(F.when(~same, F.col("place"))), F.max("place") + 1).alias("shared"))
    parted = (
        placed.join(shared, "pair_id")
        .withColumn("part", F.when(F.col("place") < F.col("shared"), "prompt").otherwise(F.col("side")))
        .where((F.col("part") != "prompt") | (F.col("side") == "chosen"))
        .withColumn("head", F.concat(F.lit(OPEN), "role", F.lit("\n")))
        .withColumn("segment", F.concat("head", "text", F.lit(CLOSE + "\n")))
        .withColumn("seq", F.when(F.col("part") == "prompt", F.col("place")).otherwise(F.col("place") - F.col("shared")))
    )
    laid = running(parted, ["pair_id", "part"], F.floor(F.col("seq") / BLOCK), ["seq"], F.length("segment").cast("long"), "start")
    end = F.col("start") + F.length("segment")
    trained = (F.col("role") == TRAINED_ROLE) & (F.col("part") != "prompt")
    return laid.select(
        "pair_id", "part", F.col("seq").cast("long").alias("seq"), "role", "segment", "start", end.alias("end"),
        F.when(trained, F.col("start") + F.length("head")).alias("trained_start"), F.when(trained, end - 1).alias("trained_end"),
    )


def assembled(segments: DataFrame) -> DataFrame:
    """One row per pair with ``prompt``, ``chosen``, ``rejected`` and the masks; each pair must fit in one row."""
    kinds = ("prompt", "chosen", "rejected")
    row = F.struct("seq", "segment", "trained_start", "trained_end")
    out = segments.groupBy("pair_id").agg(*[F.array_sort(F.collect_list(F.when(F.col("part") == k, row))).alias(f"_{k}") for k in kinds])
    spans = lambda c: F.transform(F.filter(c, lambda x: x["trained_start"].isNotNull()), lambda x: F.array(x["trained_start"], x["trained_end"]))
    texts = {k: F.array_join(F.transform(f"_{k}", lambda x: x["segment"]), "") for k in kinds}
    masks = {f"{k}_mask": spans(f"_{k}") for k in kinds[1:]}
    return out.withColumns(texts | masks).drop(*[f"_{k}" for k in kinds])


def against_garbled(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs for a table without preferences: each conversation as chosen, and as rejected with its last answer's words reversed."""
    rows = conversations.select(F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    last = rows.where(F.col("role") == TRAINED_ROLE).groupBy("pair_id").agg(F.max("turn").alias("last"))
    garbled = F.array_join(F.reverse(F.split("text", " ")), " ")
    answer = (F.col("turn") == F.col("last")) & (F.col("role") == TRAINED_ROLE)
    return rows, rows.join(last, "pair_id", "left").withColumn("text", F.when(answer, garbled).otherwise(F.col("text"))).drop("last")
