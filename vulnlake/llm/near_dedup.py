"""Near-duplicate groups by SuperMinHash, banding, verification and union-find.

1. A task hashes the word shingles of its texts and signs each set of shingles. SuperMinHash walks, for every
   element, a random permutation of the slots and offers slot ``p(j)`` the value ``j + r``; once every slot of a
   text holds a value below the next level, no later level can change it and the walk stops.
2. Equal sets are joined first (by digest), so copies never meet each other again: one row per set goes on.
3. Bands of the signature give buckets. Rows and bands are chosen so that a pair at the threshold is missed with a
   probability of at most ``miss``.
4. Candidates are compared on their full sets. In each bucket one hub is compared with all others and linked rows are
   united. A bucket whose other members are then in one component is done. The members of the rest meet through a
   prefix of their shingles, rare ones first, and the places of shared ones rule most pairs out. So every pair that could
   still change a component is compared, without pairing a group with itself.
5. Links are united by union-find in each task and by star contraction over all tasks.

Edge cases: a text with fewer words than a shingle is one shingle, its whole sequence; texts without words and
null texts have an empty set, are linked with nothing and kept; rows with a null key stand alone, with a null
component; repeated rows fall into one component; an empty table gives an empty result; only key and text are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vulnlake.llm import common as C

BLOCK = 16_384
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def plan_bands(percent: int, miss: float = 1e-7, most: int = 56) -> tuple[int, int]:
    """Bands and rows: the most selective bands with which a pair at the threshold is missed at most so often."""
    for rows in range(16, 0, -1):
        hit = (percent / 100) ** rows
        bands = math.ceil(math.log(miss) / math.log1p(-hit)) if hit < 1 else 1
        if bands <= most:
            return bands, rows
    raise ValueError("no banding reaches this threshold")


def shingle_sets(data: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of texts, sorted within a text, and where each text's set starts (and the end)."""
    n = len(at) - 1
    data = C.lower_ascii()[data]
    starts, ends, owner = C.runs(~C.table_of(b" \t\n\v\f\r")[data], at)
    words = C.run_hashes(data, starts, ends)
    counts = np.bincount(owner, minlength=n)
    hashes, first = C.windows(words, owner, size)
    parts, owners = [hashes], [owner[first]]
    for fewer in range(1, size):
        own = np.flatnonzero(counts[owner] == fewer)
        hashes, first = C.windows(words[own], owner[own], fewer)
        parts.append(hashes)
        owners.append(owner[own][first])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    flat, owner = np.concatenate(parts)[order], owner[order]
    edge = np.searchsorted(owner, np.arange(n + 1))
    for a, b in zip(edge[:-1], edge[1:]):
        flat[a:b].sort()
    new = np.ones(len(flat), bool)
    new[1:] = (flat[1:] != flat[:-1]) | (owner[1:] != owner[:-1])
    flat, owner = flat[new], owner[new]
    return flat, np.searchsorted(owner, np.arange(n + 1))


def super_minhash(flat: np.ndarray, at: np.ndarray, slots: int) -> np.ndarray:
    """Signatures of sets, one row each; slot values are ``level << 32 | fraction``. Empty sets keep the largest value."""
    n = len(at) - 1
    out = np.full((n, slots), np.iinfo(np.uint64).max, np.uint64)
    sizes = np.diff(at)
    order = np.argsort(sizes, kind="stable")
    order = order[sizes[order] > 0]
    ends = np.cumsum(sizes[order])
    first = 0
    while first < len(order):
        start = ends[first - 1] if first else 0
        end = max(first + 1, int(np.searchsorted(ends, start + BLOCK, "right")))
        texts = order[first:end]
        size = sizes[texts]
        index = np.repeat(at[texts] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        out[texts] = _sign(flat[index], np.repeat(np.arange(len(texts)), size), len(texts), slots)
        first = end
    return out


def _sign(elements: np.ndarray, text: np.ndarray, n: int, slots: int) -> np.ndarray:
    sig = np.full(n * slots, np.iinfo(np.uint64).max, np.uint64)
    places = np.zeros((0, 0), np.uint16)
    for level in range(slots):
        r = C.mix(elements + np.uint64((level + 1) * int(GOLDEN) % 2**64))
        k = level + ((r & np.uint64(0xFFFFFFFF)) * np.uint64(slots - level) >> np.uint64(32)).astype(np.int64)
        row = np.arange(len(elements))
        slot = k if level == 0 else places[row, k].astype(np.int64)
        np.minimum.at(sig, text * slots + slot, np.uint64(level << 32) | (r >> np.uint64(32)))
        open_ = sig.reshape(n, slots).max(axis=1) >= np.uint64((level + 1) << 32)
        keep = open_[text]
        if not keep.any():
            break
        if level == 0:
            elements, text, k = elements[keep], text[keep], k[keep]
            places = np.tile(np.arange(slots, dtype=np.uint16), (len(elements), 1))
            row = np.arange(len(elements))
            places[row, k] = 0  # the permutation's first place is taken; what stood there moves to k
            continue
        places[row, k] = places[:, level]
        if not keep.all():
            elements, text, places = elements[keep], text[keep], places[keep]
    return sig.reshape(n, slots)


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    cells = signatures.reshape(len(signatures), bands, rows)
    keys = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(signatures), 1))
    for i in range(rows):
        keys = C.mix(keys * GOLDEN + cells[:, :, i])
    return keys


def signed(df: DataFrame, key: str, text: str, size: int, bands: int, rows: int) -> DataFrame:
    """Per text: key, set size, the set's digest as two numbers, and its band keys (none for an empty set)."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for first, end, data, at in C.text_chunks(batch, text):
                flat, edge = shingle_sets(data, at, size)
                sizes = np.diff(edge)
                keys = band_keys(super_minhash(flat, edge, bands * rows), bands, rows)[sizes > 0]
                ends = np.concatenate([[0], np.cumsum(np.where(sizes > 0, bands, 0))]).astype(np.int32)
                digests = np.array(
                    [np.frombuffer(hashlib.blake2b(flat[a:b].tobytes(), digest_size=16).digest(), np.int64) for a, b in zip(edge[:-1], edge[1:])]
                ).reshape(-1, 2)
                columns = [
                    batch.column(key).slice(first, end - first),
                    pa.array(sizes.astype(np.int64)),
                    pa.array(digests[:, 0].copy()),
                    pa.array(digests[:, 1].copy()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel().view(np.int64))),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["key", "n_shingles", "set_a", "set_b", "bands"])

    kind = dict(df.dtypes)[key]
    return df.select(key, text).mapInArrow(batches, f"key {kind}, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>")


def sets_of(df: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """The full shingle set of every text."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for first, end, data, at in C.text_chunks(batch, text):
                flat, edge = shingle_sets(data, at, size)
                sets = pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), pa.array(flat.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(key).slice(first, end - first), sets], ["key", "shingles"])

    kind = dict(df.dtypes)[key]
    return df.select(key, text).mapInArrow(batches, f"key {kind}, shingles array<bigint>")


def similar(common: Column, left: Column, right: Column, percent: int) -> Column:
    return 100 * common >= percent * (left + right - common)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the pairs ``a``, ``b`` those whose full sets are similar enough; sizes that rule it out are seen first."""
    left, right = sets.select(F.col("key").alias("a"), F.col("shingles").alias("sa")), sets.select(F.col("key").alias("b"), F.col("shingles").alias("sb"))
    met = pairs.join(left, "a").join(right, "b")
    na, nb = F.size("sa"), F.size("sb")
    possible = 100 * F.least(na, nb) >= percent * F.greatest(na, nb)
    common = F.size(F.when(possible, F.array_intersect("sa", "sb")).otherwise(F.array().cast("array<bigint>")))
    return met.where(possible & similar(common, na, nb, percent)).select("a", "b")


def united(links: DataFrame, folder: str) -> DataFrame:
    """Components of the links ``a``, ``b``: ``node`` and ``root``, the smallest node reachable, for every node but roots.

    Each task first unites what it holds and passes on a forest. Then large-star and small-star steps hang every
    node under the smallest neighbour until nothing changes; each step is written, so a lost executor costs one step.
    """
    kind = dict(links.dtypes)["a"]

    def forest(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            parent: dict[int, int] = {}

            def find(x: int) -> int:
                while (up := parent.setdefault(x, x)) != x:
                    parent[x] = parent[up]
                    x = up
                return x

            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
            pairs = [(x, find(x)) for x in list(parent)]
            pairs = [(x, y) for x, y in pairs if x != y]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in pairs], batch.schema.field("a").type), pa.array([p[1] for p in pairs], batch.schema.field("a").type)], ["u", "v"]
            )

    edges = C.stage(links.where("a <> b").mapInArrow(forest, f"u {kind}, v {kind}"), f"{folder}/forest")
    step = 0
    while not stars(edges):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        met = large.join(least, "u")
        small = met.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(met.select("u", F.col("m").alias("v"))).distinct()
        edges = C.stage(small, f"{folder}/step{step}")
        step += 1
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def stars(edges: DataFrame) -> bool:
    """Whether every node hangs under one other at most, and none hangs under a node that hangs itself."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("x"), F.lit(1).alias("up")), F.struct(F.col("v").alias("x"), F.lit(0).alias("up")))).alias("e"))
    sides = ends.groupBy("e.x").agg(F.sum("e.up").alias("ups"), F.min("e.up").alias("low"))
    return sides.where("ups > 1 or (ups > 0 and low = 0)").isEmpty()


def prefix_pairs(sets: DataFrame, percent: int, folder: str) -> DataFrame:
    """Pairs ``a``, ``b`` of ``sets`` (``key``, ``root``, ``shingles``) that can be similar and are in different components.

    Shingles are put in one order for all sets, rare ones first. Similar sets share a shingle among the first few of
    each, and the places of the first one they share bound how much they can have in common; so no similar pair is
    missed. Of the sets that share a shingle, those of its most frequent component are only met by the others.
    """
    one = sets.select("key", "root", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    often = one.groupBy("shingle").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    ordered = one.join(often, "shingle", "left").groupBy("key", "root", "n").agg(F.sort_array(F.collect_list(F.struct(F.coalesce("often", F.lit(1)).alias("often"), "shingle"))).alias("all"))
    first = F.col("n") - F.floor((percent * F.col("n") + 99) / 100).cast("int") + 1
    head = ordered.select("key", "root", "n", F.posexplode(F.slice("all", F.lit(1), first)).alias("at", "s"))
    head = C.stage(head.where("s.often > 1").select("key", "root", "n", "at", F.col("s.shingle").alias("shingle")), f"{folder}/heads")
    common = head.groupBy("shingle", "root").agg(F.count(F.lit(1)).alias("n")).groupBy("shingle").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.count(F.lit(1)).alias("roots"))
    mixed = head.join(common.where("roots > 1").select("shingle", "main"), "shingle")
    left = mixed.where("root <> main").select("shingle", *[F.col(c).alias(f"{c}_a") for c in ("key", "root", "n", "at")])
    most = F.least(F.col("n_a") - F.col("at_a"), F.col("n") - F.col("at"))  # this one and what follows it
    needed = F.ceil(percent * (F.col("n_a") + F.col("n")) / (100 + percent))
    possible = (F.col("root_a") != F.col("root")) & ((F.col("root") == F.col("main")) | (F.col("key_a") < F.col("key")))
    possible = possible & (100 * F.least("n_a", "n") >= percent * F.greatest("n_a", "n")) & (most >= needed)
    return left.join(mixed, "shingle").where(possible).select(F.least("key_a", "key").alias("a"), F.greatest("key_a", "key").alias("b")).distinct()


def linked(members: DataFrame, sets: DataFrame, percent: int, folder: str) -> DataFrame:
    """Components (``node``, ``root``) of all similar pairs that share a bucket; ``members``: ``bucket``, ``key``.

    First every member meets its bucket's smallest key. Members of buckets that still hold several components then
    meet each other through the shingles that similar sets must share.
    """
    hub = members.groupBy("bucket").agg(F.min("key").alias("a"))
    pairs = members.join(hub, "bucket").where("a < key").select("a", F.col("key").alias("b")).distinct()
    roots = united(verified(C.stage(pairs, f"{folder}/pairs"), sets, percent), f"{folder}/united")
    left = members.join(hub.select("bucket", F.col("a").alias("key")), ["bucket", "key"], "left_anti")
    here = left.join(roots, left["key"] == roots["node"], "left").select("bucket", "key", F.coalesce("root", "key").alias("root"))
    open_ = here.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("bucket")
    wide = C.stage(here.join(open_, "bucket", "left_semi").groupBy("key").agg(F.min("root").alias("root")), f"{folder}/open")
    rest = C.stage(prefix_pairs(sets.join(wide, "key"), percent, folder), f"{folder}/rest")
    if rest.isEmpty():
        return roots
    links = verified(rest, sets, percent).union(roots.select(F.col("root").alias("a"), F.col("node").alias("b")))
    return united(links, f"{folder}/united-all")


def near_groups(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """Per row: key, ``n_shingles``, ``component_id`` (the smallest key of the group) and ``kept``."""
    folder = C.scratch(df.sparkSession, "near")
    bands, rows = plan_bands(percent)
    all_rows = C.stage(signed(df, key, text, size, bands, rows), f"{folder}/signed")
    solid = all_rows.where((F.col("n_shingles") > 0) & F.col("key").isNotNull())
    reps = C.stage(solid.groupBy("set_a", "set_b").agg(F.min("key").alias("rep")), f"{folder}/reps")
    one = solid.join(reps.select(F.col("rep").alias("key")), "key", "left_semi")
    buckets = one.select("key", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    members = C.stage(buckets.join(shared, "bucket", "left_semi"), f"{folder}/members")
    wanted = members.select("key").distinct()
    texts = df.select(F.col(key).alias("key"), F.col(text).alias("text")).join(wanted, "key", "left_semi")
    sets = C.stage(sets_of(texts, "key", "text", size).dropDuplicates(["key"]), f"{folder}/sets")
    roots = linked(members, sets, percent, folder)
    named = reps.join(roots, reps["rep"] == roots["node"], "left").select("set_a", "set_b", F.coalesce("root", "rep").alias("component"))
    out = all_rows.drop("bands").join(named, ["set_a", "set_b"], "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("key").isNotNull(), F.col("component")).otherwise(F.col("key"))
    return out.select(F.col("key").alias(key), "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("key")).alias("kept"))
