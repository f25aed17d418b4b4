"""Rule ledger, digest index, shards and near dedup against brute force."""

import collections
import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from awkward import SF_DIR, documents, no_documents  # noqa: F401
from vulnlake.llm import common, exact_dedup, near_dedup, quality_rules, queries, sharding

SPACE = "[\x20\x09-\x0d]+"


def words(text):
    return [w for w in re.split(SPACE, text or "") if w]


def measures(text):
    text, w = text or "", words(text)
    lines = [x for x in text.split("\n") if words(x)]
    seen = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    twice = {i + k for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for k in range(8)}
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(w), sum(map(len, w)), symbols, len(lines), len(lines) - len(set(lines)), len(twice)


def test_ledger_measures(documents):
    rows = quality_rules.ledger(documents).collect()
    source = {(r.doc_id, r.text) for r in documents.collect()}
    expected = collections.Counter((i, *measures(t)) for i, t in source for _ in range(2 if i == 9 else 1))
    assert collections.Counter(tuple(r[:7]) for r in rows) == expected


def test_ledger_policies_and_ablation(documents, no_documents):
    rows = quality_rules.ledger(documents).cache()
    for version, rules in quality_rules.POLICIES.items():
        lines = {r.rule: r for r in quality_rules.ablation(rows, version).collect()}
        bits = [r.bits for r in rows.collect()]
        for rule in rules:
            one, whole = quality_rules.mask((rule,)), quality_rules.mask(rules)
            assert lines[rule].failed == sum(b & one > 0 for b in bits)
            assert lines[rule].failed_alone == sum(b & whole == one for b in bits)
    assert rows.where(F.col("doc_id") == 14).first().bits & quality_rules.mask(("symbols",))
    assert quality_rules.ledger(no_documents).collect() == []


def test_measures_avoid_clashing_names(documents):
    name = common.free_name(documents, "measures")
    assert name == "_measures" and quality_rules.measured(documents, "text", name).count() == documents.count()


def test_digest_index(spark, documents, no_documents):
    rows = exact_dedup.digests(documents)
    index = exact_dedup.DigestIndex(spark, common.scratch(spark, "test-index"), buckets=4)
    index.add(0, exact_dedup.digests(no_documents))
    assert index.rows().count() == 0
    for _ in range(2):  # a batch that is run again replaces itself
        index.add(1, rows.where("doc_id <= 3"))
        index.add(2, rows.where("doc_id > 3 or doc_id is null"))
    groups = collections.defaultdict(list)
    for r in documents.collect():
        groups[re.sub(SPACE, " ", r.text or "")].append(r.doc_id)
    expected = collections.Counter()
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        for i in ids:
            expected[i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()] += 1
    got = index.decide(rows).select("doc_id", "keep_id", "group_size", "kept", "digest").collect()
    assert collections.Counter(map(tuple, got)) == expected


def test_reopened_index_is_persistent(spark, documents):
    path = common.scratch(spark, "test-index")
    exact_dedup.DigestIndex(spark, path, buckets=4).add(0, exact_dedup.digests(documents))
    again = exact_dedup.DigestIndex(spark, path, buckets=4)
    before = again.rows().count()
    again.add(1, exact_dedup.digests(documents))
    assert again.rows().count() == before > 0


def test_anti_join_does_not_shuffle_the_index(spark, documents):
    index = exact_dedup.DigestIndex(spark, common.scratch(spark, "test-index"), buckets=4)
    index.add(0, exact_dedup.digests(documents))
    fresh = exact_dedup.digests(documents).groupBy("digest").agg(F.min("doc_id").alias("keep_id"))
    plan = fresh.join(index.rows().select("digest").hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" in plan


@pytest.mark.parametrize("shards", [1, 4, 40])
def test_interleaving(documents, shards):
    rows = documents.select("doc_id", "source", F.length("text").alias("n"))
    got = sharding.interleave(rows, "source", ["doc_id", "n"], shards).collect()
    assert len(got) == documents.count()
    sizes = collections.Counter(r.shard for r in got)
    counts = [sizes.get(k, 0) for k in range(shards)]
    assert max(counts) - min(counts) <= 1
    for k, n in sizes.items():
        assert sorted(r.slot for r in got if r.shard == k) == list(range(n))


def test_every_shard_has_the_mixture(spark):
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"))
    got = sharding.interleave(rows, "source", ["doc_id"], 10).groupBy("shard", "source").count().collect()
    whole = collections.Counter()
    for r in got:
        whole[r.source] += r["count"]
    for r in got:
        assert abs(r["count"] - whole[r.source] / 10) <= 2
    assert sharding.interleave(rows.limit(0), "source", ["doc_id"], 10).count() == 0


def shingles(text, size):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def components(rows, size, percent):
    sets = {i: shingles(t, size) for i, t in rows if i is not None}
    root = {i: i for i in sets}

    def find(x):
        return x if root[x] == x else find(root[x])

    for a, b in itertools.combinations(sorted(sets), 2):
        c = len(sets[a] & sets[b])
        if c and 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


@pytest.mark.parametrize("size, percent", [(3, 85), (5, 80)])
def test_near_groups_on_awkward_rows(documents, no_documents, size, percent):
    got = near_dedup.near_groups(documents, size=size, percent=percent).collect()
    expected = components([(r.doc_id, r.text) for r in documents.collect()], size, percent)
    assert len(got) == documents.count()
    for r in got:
        assert tuple(r[1:]) == (expected[r.doc_id] if r.doc_id is not None else (len(shingles("row without an id", size)), None, True))
    assert near_dedup.near_groups(no_documents).collect() == []


def test_chains_and_large_groups(spark):
    rng = random.Random(3)
    rows, n = [], 0
    for chain in range(3):
        w = [f"c{chain}w{i}" for i in range(120)]
        for _ in range(25):
            rows.append((n, " ".join(w)))
            w = w[:]
            w[rng.randrange(120)] = f"n{n}"
            n += 1
    base = [f"hot{i}" for i in range(100)]
    for _ in range(60):
        w = base[:]
        for k in rng.sample(range(100), rng.randint(0, 4)):
            w[k] = f"r{rng.random()}"
        rows.append((n, " ".join(w)))
        n += 1
    got = near_dedup.near_groups(spark.createDataFrame(rows, "doc_id bigint, text string"), size=3, percent=85).collect()
    expected = components(rows, 3, 85)
    assert {r.doc_id: tuple(r[1:]) for r in got} == expected


def test_signature_is_a_minhash():
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 2**63, 300).astype(np.uint64), rng.integers(0, 2**63, 60).astype(np.uint64)
    both = np.concatenate([a, a[60:], b])
    sig = near_dedup.super_minhash(both, np.array([0, 300, 600]), 512)
    assert abs((sig[0] == sig[1]).mean() - 240 / 360) < 0.07
    assert (sig >> np.uint64(32) < 512).all()


def test_registered_on_small_tables(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    got = queries.op9_super_minhash(spark, SF_DIR).collect()
    assert {r.doc_id: tuple(r[1:]) for r in got} == components([(r.doc_id, r.text) for r in docs], 3, 85)
