"""Merkle manifest of a dataset by sibling-shift self-joins.

Every row is a leaf. Leaves of a tree (a source, say) stand in the order of their key; while a level has more than one
node, every ``arity`` consecutive ones become the digest of their digests, and the trees' tops are the leaves of one more
tree, whose top is the root. On each level the first node of a run computes the indices of its siblings (XOR of its
own in a binary tree, its own plus the slot otherwise), an equijoin on tree and index fetches them, and that slot-zero
row emits the parent. So a run, never a tree, is what comes together in one place, and a tree of any size is spread over
all tasks. Each level is written before the next begins.

Indices come from one range sort over tree and key: rows are numbered within a partition, and the partitions' counts
give each its offset. Proofs go down the same runs: a child's path is its siblings, then its parent's path; only one
row per run is joined, with the upper part of the path that its children share.

Edge cases: null in a field has a mark of its own; a null tree or key comes first; rows that share a key are ordered by
their digest, and rows equal in that too are interchangeable; a tree of one leaf is its own top; a run of one node in
a longer level is still digested; an empty table has no leaves and no root; other columns of the table are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vulnlake.llm import common as C

ARITY = 16
HEX = 64
#: ``monotonically_increasing_id`` keeps the partition above these bits.
ROW_BITS = 33


def field(column: Column) -> Column:
    """``-`` for null, else the length in UTF-8 bytes, a colon, and the value."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*columns: Column) -> Column:
    """Digest of a row: of its fields, one after the other."""
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def numbered(df: DataFrame, by: list[str], name: str, into: str) -> DataFrame:
    """``df``, written in the order of ``by``, with every row's number from 0 in ``into``."""
    row, part = C.free_name(df, "row"), "_part"
    spread = df.withColumn(row, F.monotonically_increasing_id()).repartitionByRange(_tasks(df), *by, row)
    placed = spread.sortWithinPartitions(*by, row).withColumn(row, F.monotonically_increasing_id())
    placed = C.stage(placed, C.scratch(df.sparkSession, name))
    sizes = placed.groupBy(F.shiftright(row, ROW_BITS).alias(part)).agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition of the sort.
    starts = sizes.select(part, F.expr(f"sum(_n) OVER (ORDER BY {part}) - _n").alias("_start"))
    local = F.col(row) - F.shiftleft(F.shiftright(row, ROW_BITS), ROW_BITS)
    return placed.join(starts, F.shiftright(row, ROW_BITS) == F.col(part)).withColumn(into, F.col("_start") + local).drop(row, part, "_start")


def _tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def climbed(nodes: DataFrame, held: list[str], arity: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Runs of every level, and the tops.

    ``nodes``: ``tree``, ``idx``, ``digest``, ``n`` (nodes of the tree) and the columns ``held``, which stay with their
    leaf in ``children``. A run bears its parent's index, digest and level size. Tops: ``tree``, ``level``, ``digest``.
    """
    size = nodes.agg(F.max("n")).first()[0] or 0
    runs: list[DataFrame] = []
    tops = nodes.where("n = 1").select("tree", F.lit(0).alias("level"), "digest")
    level, extra = nodes, held
    while size > 1:
        last = F.least(F.lit(arity), F.col("n") - F.col("idx")) - 1
        asked = level.where((F.col("n") > 1) & (F.col("idx") % arity == 0)).select(
            "tree", F.col("idx").alias("first"), "n", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("shift")
        )
        sibling = F.col("first").bitwiseXOR(F.col("shift")) if arity == 2 else F.col("first") + F.col("shift")
        asked = asked.withColumn("sibling", sibling)
        found = level.select(F.col("tree").alias("_tree"), F.col("idx").alias("_idx"), "digest", *extra)
        met = asked.join(found, (F.col("tree") == F.col("_tree")) & (F.col("sibling") == F.col("_idx")))
        run = met.groupBy("tree", "first", "n").agg(F.array_sort(F.collect_list(F.struct("shift", "digest", *extra))).alias("run"))
        text = F.array_join(F.transform("run", lambda c: c["digest"]), "")
        emitted = run.select(
            "tree",
            F.expr(f"first div {arity}").alias("idx"),
            F.expr(f"(n + {arity - 1}) div {arity}").alias("n"),
            text.alias("digests"),
            F.sha2(text, 256).alias("digest"),
            *([F.transform("run", lambda c: F.struct(*[c[e].alias(e) for e in extra])).alias("children")] if extra else []),
        )
        runs.append(C.stage(emitted, C.scratch(nodes.sparkSession, f"{name}-{len(runs)}")))
        level, extra = runs[-1].select("tree", "idx", "n", "digest"), []
        tops = tops.unionByName(level.where("n = 1").select("tree", F.lit(len(runs)).alias("level"), "digest"))
        size = -(-size // arity)
    return runs, tops


def _sides(slot: str) -> Column:
    return F.struct(
        F.expr(f"substring(digests, 1, {HEX} * CAST({slot} AS INT))").alias("left"),
        F.expr(f"substring(digests, {HEX} * (CAST({slot} AS INT) + 1) + 1)").alias("right"),
    )


PATH = "array<struct<left:string,right:string>>"


def descended(runs: list[DataFrame], tops: DataFrame, arity: int, shared: list[str]) -> DataFrame:
    """Runs of the lowest level, each with its parent's ``path`` upwards and the columns ``shared`` of its tree's top.

    ``tops``: ``tree``, ``level``, ``path`` and ``shared``.
    """
    below = None
    for k in range(len(runs) - 1, -1, -1):
        above = tops.where(F.col("level") == k + 1).select("tree", F.lit(0).cast("long").alias("idx"), "path", *shared)
        if below is not None:
            child = below.select("tree", "idx", "digests", "path", *shared, F.expr(f"explode(sequence(0, length(digests) div {HEX} - 1))").alias("slot"))
            path = F.concat(F.array(_sides("slot")), F.col("path"))
            above = above.unionByName(child.select("tree", (F.col("idx") * arity + F.col("slot")).alias("idx"), path.alias("path"), *shared))
        below = runs[k].drop("n", "digest").join(above, ["tree", "idx"])
    return below


def manifest(leaves: DataFrame, key: str, tree: str, leaf: str = "leaf", held: tuple[str, ...] = (), arity: int = ARITY) -> DataFrame:
    """Every leaf with its ``subroot`` (its tree's top), the ``root``, and its ``path`` of siblings from the leaf to the root.

    ``leaves`` has a digest per row in ``leaf``; ``held`` columns come along. A path is a list of ``left`` and ``right``
    digests in hex; :func:`folded` follows it and :func:`siblings` lists them.
    """
    spark = leaves.sparkSession
    rows = leaves.select(F.col(key).alias("key"), F.col(tree).alias("source"), F.col(leaf).alias("digest"), *held)
    placed = C.stage(numbered(rows, ["source", "key", "digest"], "merkle-leaves", "place").withColumn("block", F.expr(f"place div {1 << 16}")), C.scratch(spark, "merkle-places"))

    # Trees in the order of their first leaf, which is that of their names. Counted by block first, so that a large
    # tree does not meet in one task, neither here nor where its leaves get their numbers.
    pieces = placed.groupBy("source", "block").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("start"))
    trees = pieces.groupBy("source").agg(F.sum("n").alias("n"), F.min("start").alias("start"))
    trees = C.stage(numbered(trees, ["start"], "merkle-trees", "tree"), C.scratch(spark, "merkle-tree-numbers"))
    known = pieces.select("source", "block").join(trees.select(F.col("source").alias("_source"), "tree", "n", "start"), F.col("source").eqNullSafe(F.col("_source")))
    known = known.select(F.col("source").alias("_source"), F.col("block").alias("_block"), "tree", "n", "start")
    same = (placed["block"] == F.col("_block")) & placed["source"].eqNullSafe(F.col("_source"))
    nodes = placed.join(known, same).select("tree", (F.col("place") - F.col("start")).alias("idx"), "n", "digest", "key", *held)
    nodes = C.stage(nodes, C.scratch(spark, "merkle-nodes"))
    runs, tops = climbed(nodes, ["key", *held], arity, "merkle-runs")

    # The tops are the leaves of the last tree; its own top is the root.
    upper = tops.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(trees.count()).alias("n"), "digest", "level")
    upper = C.stage(upper, C.scratch(spark, "merkle-tops"))
    upper_runs, upper_tops = climbed(upper, ["level"], arity, "merkle-upper")
    root = upper_tops.select("tree", F.col("level").alias("root_level"), F.col("digest").alias("root"))
    if upper_runs:
        none = F.array().cast(PATH)
        base = descended(upper_runs, root.select("tree", F.col("root_level").alias("level"), none.alias("path"), "root"), arity, ["root"])
        child = base.select("idx", "digests", "path", "root", F.posexplode("children").alias("slot", "child"))
        topped = child.select(
            (F.col("idx") * arity + F.col("slot")).alias("tree"),
            F.col("child.level").alias("level"),
            F.concat(F.array(_sides("slot")), F.col("path")).alias("path"),
            F.expr(f"substring(digests, {HEX} * slot + 1, {HEX})").alias("subroot"),
            "root",
        )
    else:
        topped = upper.select(F.col("idx").alias("tree"), "level", F.array().cast(PATH).alias("path"), F.col("digest").alias("subroot"), F.col("digest").alias("root"))
    topped = C.stage(topped, C.scratch(spark, "merkle-topped"))

    out = [F.col(c) for c in ("subroot", "root", "path")]
    lone = nodes.where("n = 1").join(topped.where("level = 0"), "tree").select(F.col("key").alias(key), F.col("digest").alias(leaf), *held, *out)
    if not runs:
        return lone
    base = descended(runs, topped, arity, ["subroot", "root"])
    child = base.select("digests", "path", "subroot", "root", F.posexplode("children").alias("slot", "child"))
    own = F.expr(f"substring(digests, {HEX} * slot + 1, {HEX})")
    whole = child.select(
        F.col("child.key").alias(key), own.alias(leaf), *[F.col(f"child.{h}").alias(h) for h in held],
        "subroot", "root", F.concat(F.array(_sides("slot")), F.col("path")).alias("path"),
    )
    return whole.unionByName(lone)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf's digest and a path give."""
    return F.aggregate(path, leaf, lambda h, p: F.sha2(F.concat(p["left"], h, p["right"]), 256))


def siblings(path: Column) -> Column:
    """All digests of a path in one text, from the leaf upwards and from left to right."""
    return F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), "")
