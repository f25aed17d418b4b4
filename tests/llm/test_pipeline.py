"""Every stage of the pipeline over all rows against brute force, each on what the stage before kept."""

import collections
import hashlib
import re

import numpy as np
import public_tokenizers
from test_rules_and_dedup import SPACE, components, measures
from tokenizers import Tokenizer

import corpus_pipeline
from awkward import SF_DIR
from vulnlake.llm import bpe, common, mixing, quality_rules


def accepted(text):
    order = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
    values = dict(zip(order, measures(text)))
    return not any(eval(quality_rules.RULES[r], {}, values) for r in quality_rules.POLICIES[max(quality_rules.POLICIES)])


def fitted(tokens, posterior, least, targets):
    """The rates, by the same steps in numpy."""
    rate, best, since, factor = np.ones(len(tokens)), np.inf, 0, 1.0
    for _ in range(mixing.STEPS):
        totals = (rate * tokens) @ posterior
        worst = mixing.misses(totals, targets).max()
        since = 0 if worst < best * (1 - mixing.STALL_GAIN) else since + 1
        factor = max(factor / 2, 1 / 16) if worst > best else min(1.0, factor * 2)
        best = min(best, worst)
        if worst <= mixing.TOLERANCE or since >= mixing.STALLED:
            break
        residual = totals - targets
        free = (rate > least) | (posterior @ residual < 0)
        h = (posterior * (tokens * free)[:, None]).T @ posterior
        move = posterior @ (factor * np.linalg.solve(h + np.eye(len(targets)) * max(1e-9 * np.trace(h), 1e-9), residual))
        rate = np.where(tokens > 0, np.maximum(least, rate - move), rate)
    return rate


def copies(key, rate):
    share = int(hashlib.md5(f"mix:{key}".encode()).hexdigest()[:12], 16) / 2**48
    return int(rate) + (share < rate - int(rate))


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    kept, frames = {}, {}
    for name, apply in corpus_pipeline.STAGES:
        docs = common.stage(apply(spark, docs, SF_DIR), common.scratch(spark, name))
        frames[name], kept[name] = docs, collections.Counter(r.doc_id for r in docs.select("doc_id").collect())

    assert kept["quality_rules"] == collections.Counter(i for i, t in text.items() if accepted(t))

    groups = collections.defaultdict(list)
    for i in kept["quality_rules"]:
        groups[re.sub(SPACE, " ", text[i] or "")].append(i)
    assert kept["exact_dedup"] == collections.Counter(min(ids) for ids in groups.values())

    roots = components([(i, text[i]) for i in kept["exact_dedup"]], 5, 80)
    assert kept["near_dedup"] == collections.Counter(i for i, group in roots.items() if group[2])

    labels = mixing.domains_of(spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    rows = sorted(mixing.mixed(frames["near_dedup"], labels, mixing.MIXTURE).collect(), key=lambda r: r.doc_id)
    tokens, posterior, least = (np.array([getattr(r, c) for r in rows], float) for c in ("tokens", "posterior", "least"))
    said = {r.doc_id: r.domain for r in labels.collect()}
    domains = sorted(set(said.values()))
    assert [x == 1.0 for x in least] == [said.get(r.doc_id, domains[int(np.argmax(r.posterior))]) in mixing.KEEP for r in rows]
    rate = fitted(tokens, posterior, least, (tokens @ posterior) * np.array([mixing.MIXTURE[d] for d in domains]))
    assert np.allclose(rate, [r.rate for r in rows], atol=1e-6)
    assert kept["mixing"] == collections.Counter({r.doc_id: copies(r.doc_id, r.rate) for r in rows if copies(r.doc_id, r.rate)})

    tokenizer = Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    assert kept["bpe"] == kept["mixing"]
    for r in frames["bpe"].collect():
        ids = tokenizer.encode(text[r.doc_id] or "", add_special_tokens=False).ids
        back = tokenizer.decode(ids, skip_special_tokens=False)
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest() and r.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()
