"""Mixing by held-out accuracy and met targets, secrets by held-out labels, chat formatting by brute force, the pipeline end to end."""

import collections
import hashlib
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from awkward import SF_DIR, documents, no_documents  # noqa: F401
from vulnlake.llm import chat_format, common, mixing, queries, secret_scan, stages


def labelled_texts(n, seed):
    rng = random.Random(seed)
    plain = [f"word{i}" for i in range(400)]
    marks = {"toxic": ["vile", "nasty", "awful"], "low": ["###", "zzz", "click"], "clean": ["study", "method", "result"]}
    rows = []
    for i in range(n):
        kind = rng.choice(list(marks))
        w = rng.choices(plain, k=rng.randint(20, 120)) + rng.choices(marks[kind], k=6)
        rng.shuffle(w)
        rows.append((i, " ".join(w), kind))
    return rows


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.createDataFrame(labelled_texts(600, 1), "doc_id bigint, text string, domain string").cache()


def test_posteriors_hold_out(labelled):
    classifier = mixing.fit(labelled.select("doc_id", "text"), labelled.where("doc_id % 2 = 0").select("doc_id", "domain"))
    held = classifier.posteriors(mixing.worded(labelled.where("doc_id % 2 = 1")).drop("text"))
    rows = held.collect()
    right = sum(classifier.domains[max(range(3), key=lambda k: r.posterior[k])] == r.domain for r in rows)
    assert right >= 0.95 * len(rows) and all(abs(sum(r.posterior) - 1) < 1e-6 for r in rows)


def test_rates_meet_targets_and_stay_nonnegative(spark, labelled):
    rows = mixing.mixed(labelled.select("doc_id", "text"), labelled.where("doc_id % 3 = 0").select("doc_id", "domain"), {"clean": 1.5, "toxic": 0.05, "low": 0.6}).collect()
    assert len(rows) == 600 and all(r.rate >= 0 for r in rows)
    for k, share in enumerate((1.5, 0.6, 0.05)):  # domains in the order of their names
        now = sum(r.tokens * r.posterior[k] for r in rows)
        got = sum(r.rate * r.tokens * r.posterior[k] for r in rows)
        assert abs(got - share * now) <= 2e-3 * sum(r.tokens for r in rows)
    assert all(r.copies in (int(r.rate), int(r.rate) + 1) for r in rows)
    mean = sum(r.copies for r in rows) / sum(r.rate for r in rows)
    assert abs(mean - 1) < 0.1


def test_rates_against_numpy_under_bounds(spark):
    rng = np.random.default_rng(4)
    n, tokens = 300, rng.integers(1, 400, 300).astype(float)
    posterior = rng.dirichlet([0.4, 0.4, 0.4], n)
    least = (posterior.argmax(axis=1) == 0).astype(float)
    now = tokens @ posterior
    for shares in ((1.1, 0.8, 0.6), (1.1, 0.5, 0.0)):  # the second asks for less than the bound allows
        targets = now * np.array(shares)
        rate, history = np.ones(n), []
        best, since, factor = np.inf, 0, 1.0
        for _ in range(mixing.STEPS):
            totals = (rate * tokens) @ posterior
            history.append(totals)
            worst = mixing.misses(totals, targets).max()
            since = 0 if worst < best * (1 - mixing.STALL_GAIN) else since + 1
            factor = max(factor / 2, 1 / 16) if worst > best else min(1.0, factor * 2)
            best = min(best, worst)
            if worst <= mixing.TOLERANCE or since >= mixing.STALLED:
                break
            residual = totals - targets
            free = (rate > least) | (posterior @ residual < 0)
            h = (posterior * (tokens * free)[:, None]).T @ posterior
            rate = np.maximum(least, rate - posterior @ (factor * np.linalg.solve(h + np.eye(3) * max(1e-9 * np.trace(h), 1e-9), residual)))
        frame = spark.createDataFrame([(i, float(tokens[i]), [float(p) for p in posterior[i]], float(least[i])) for i in range(n)], "doc_id bigint, tokens double, posterior array<double>, least double")
        got, steps = mixing.fit_rates(frame, [float(t) for t in targets])
        assert len(steps) == len(history)
        assert [r.rate for r in sorted(got.collect(), key=lambda r: r.doc_id)] == pytest.approx(rate.tolist(), abs=1e-6)
        assert (mixing.misses(steps[-1], targets).max() <= mixing.TOLERANCE) == (shares[2] > 0)


def test_reachable_targets_are_met_and_others_named(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = mixing.domains_of(spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    for shares in (mixing.MIXTURE, {"clean": 1.2, "low": 0.9, "toxic": 1.0}):
        rows = mixing.mixed(documents, labels, shares).collect()
        names = sorted(mixing.MIXTURE)
        for k, name in enumerate(names):
            now = sum(r.tokens * r.posterior[k] for r in rows)
            gap = abs(sum(r.rate * r.tokens * r.posterior[k] for r in rows) - shares[name] * now) / (shares[name] * now)
            assert (gap <= 0.01) == (name not in rows[0].unmet)
    assert rows[0].unmet == []


def test_residuals_fall(labelled):
    rows = mixing.worded(labelled).withColumn("posterior", F.array(*[(F.col("domain") == d).cast("double") for d in ("clean", "low", "toxic")])).drop("_words", "text")
    rows = common.stage(rows, common.scratch(rows.sparkSession, "test-rates"))
    now = rows.agg(*[F.sum(F.col("tokens") * F.col("posterior")[k]) for k in range(3)]).first()
    _, history = mixing.fit_rates(rows, [now[0] * 2, now[1], 0.0])
    gaps = [max(abs(t - g) for t, g in zip(step, (now[0] * 2, now[1], 0.0))) for step in history]
    assert gaps == sorted(gaps, reverse=True) and gaps[-1] <= 1e-3 * sum(now)


def test_mixing_awkward_rows(spark, documents, no_documents):
    labels = spark.createDataFrame([(1, "clean"), (14, "low"), (None, "low"), (999, "clean"), (2, None)], "doc_id bigint, domain string")
    rows = mixing.mixed(documents, labels, {"low": 0.0}).collect()
    assert len(rows) == documents.count()
    assert all(r.rate == 1.0 for r in rows if r.tokens == 0)
    assert mixing.mixed(no_documents, labels, {}).collect() == []
    none = mixing.mixed(documents, labels.limit(0), {}).collect()
    assert {tuple(r.posterior) for r in none} == {()} and {r.copies for r in none} == {1}


def test_clean_documents_stay_at_least_once(spark, tmp_path):
    odd = [(i, "vile nasty awful " * 5, "clean" if i % 5 == 1 else "toxic") for i in range(1000, 1060)]  # one text, mostly toxic by label
    rows = [*labelled_texts(600, 1), *odd]
    docs = spark.createDataFrame([(i, text) for i, text, _ in rows], "doc_id bigint, text string")
    spark.createDataFrame([(i, int(kind != "low"), int(kind == "toxic")) for i, _, kind in rows if i % 5], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = collections.Counter(r.doc_id for r in stages.mixture(spark, docs, str(tmp_path)).collect())
    assert {i for i, _, kind in rows if kind == "clean" and i % 5} <= set(kept)
    assert sum(n for i, n in kept.items() if i < 1000 and rows[i][2] == "toxic") < 0.3 * sum(kind == "toxic" for _, _, kind in rows)


def test_bound_of_the_rate_follows_label_then_likeliest_domain(spark):
    rows = spark.createDataFrame([(1, [0.1, 0.9]), (2, [0.9, 0.1]), (3, [0.9, 0.1]), (4, [0.1, 0.9]), (5, [0.5, 0.5]), (None, [0.9, 0.1])], "doc_id bigint, posterior array<double>")
    labels = spark.createDataFrame([(1, "clean"), (2, "low"), (3, None), (None, "low")], "doc_id bigint, domain string")
    least = lambda *keep: {r.doc_id: r.least for r in mixing.least_rates(rows, labels, ["clean", "low"], keep).collect()}
    assert least("clean") == {1: 1.0, 2: 0.0, 3: 1.0, 4: 0.0, 5: 1.0, None: 1.0}
    assert set(least().values()) == {0.0}


def test_domains_take_the_most_severe_label(spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 1), (2, 0, 0), (3, 1, 0), (4, None, None)], "doc_id bigint, quality int, toxic int")
    assert {r.doc_id: r.domain for r in mixing.domains_of(labels).collect()} == {1: "toxic", 2: "low", 3: "clean", 4: "clean"}


def secret_texts(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        kind = rng.choice(["secret", "long", "number", "none"])
        key = "".join(rng.choices("0123456789abcdef", k=rng.choice([24, 32, 40])))
        inner = {"secret": f'token = "{key}"', "long": "verylongwordinthetext" + rng.choice(["ing", "ed", "ly"]), "number": str(rng.randrange(10**15, 10**16)), "none": "short words"}[kind]
        rows.append((i, f"this is the text before {inner} and the rest of the text", rng.choice(["a", "b", None]), int(kind == "secret")))
    return rows


def test_forest_on_held_out_findings(spark):
    docs = spark.createDataFrame(secret_texts(400, 3), "doc_id bigint, text string, source string, truth int").cache()
    found = common.stage(secret_scan.candidates(docs), common.scratch(spark, "test-found"))
    described = common.stage(secret_scan.described(found, secret_scan.dictionary(docs)), common.scratch(spark, "test-described"))
    labelled = described.where("doc_id % 2 = 0").join(docs.select("doc_id", F.col("truth").alias("label")), "doc_id")
    rows = secret_scan.scored(described, labelled).join(docs.select("doc_id", "truth"), "doc_id").where("doc_id % 2 = 1").collect()
    assert rows and sum(r.is_secret == bool(r.truth) for r in rows) >= 0.98 * len(rows)


EDGES = "\"'`,;()[]{}<>"


def brute_candidates(text):
    """Word, number, value and what stands before it; key runs first, in words without one the value of a named secret or a known key."""
    w = re.split("[\x20\x09-\x0d]+", text or "")
    for i, x in enumerate(w):
        before = w[i - 1] if i else ""
        runs = list(re.finditer(r"[A-Za-z0-9+/_\-]{16,}", x))
        for k, m in enumerate(runs):
            start = runs[k - 1].start() if k else 0
            yield i, k, m[0], x[start : m.start()], before, w[i + 1] if i + 1 < len(w) else ""
        if runs or len(x) < 8 or not (len(x) >= 16 or re.search("[=:]", x) or re.search("[=:][\"'`]?$", before)):
            continue
        inner = re.match("^(.*?[=:][\"'`]?)([^=:\"'`].{7,})$", x)
        lead = x[: len(x) - len(x.lstrip(EDGES))]
        if inner and re.search(secret_scan.NAMES, inner[1]):
            lead, value = inner[1], inner[2].strip(EDGES)
        elif re.search("[=:][\"'`]?$", before) and re.search(secret_scan.NAMES, " ".join([w[i - 2] if i > 1 else "", before])):
            value = x.strip(EDGES)
        elif re.search(secret_scan.KEY_FORMS, x.lstrip(EDGES)):
            value = x.strip(EDGES)
        else:
            continue
        if len(value) >= 8:
            yield i, 0, value, lead, before, w[i + 1] if i + 1 < len(w) else ""


SECRETS = [
    'password = "hunter2!x" next', "password='p@ss.w0rd#1', user", "api_key: abc12345 done", "pass: short", "token=abc", "see http://site.example/path now",
    "AWS_SECRET_ACCESS_KEY=abcdefghijklmnop1234/ZZZ tail", "aaaaaaaaaaaaaaaaaaaa=bbbbbbbbbbbbbbbbbbbb=aaaaaaaaaaaaaaaaaaaa", "(sk_live_9a9a9a)", "name = value9999", "password =", "= password99",
]


def test_candidates_against_brute_force(spark, documents, no_documents):
    more = spark.createDataFrame([(1000 + n, t, "a") for n, t in enumerate(SECRETS)], "doc_id bigint, text string, source string")
    rows = documents.select("doc_id", "text", "source").unionByName(more)
    got = sorted((tuple(r) for r in secret_scan.candidates(rows).select("doc_id", "word_no", "run_no", "value", "prefix", "before1", "after").collect()), key=str)
    assert got == sorted(((r.doc_id, *c) for r in rows.collect() for c in brute_candidates(r.text)), key=str)
    assert secret_scan.candidates(no_documents).collect() == []


def test_features_against_brute_force(spark):
    kind = "value string, prefix string, before1 string, before2 string, after string"
    values = ["abcABC123-_/", "aaaa", "Xy", "the-quick-brown-fox", "24be64439e3e49cf46b2d7c90f3602a3", "ünïcødé-value-99", "A" * 40]
    found = spark.createDataFrame([(v, 'token="' if n % 2 else "x", "secret:" if n % 3 else "", "", "end") for n, v in enumerate(values)], kind)
    known = ["the", "qui", "uic", "ick", "abc", "val", "alu"]
    got = {r.value: r for r in secret_scan.described(found, spark.createDataFrame([(g,) for g in known], "gram string")).collect()}
    for n, v in enumerate(values):
        r, size, low = got[v], len(v), v.lower()
        grams = [low[k : k + 3] for k in range(max(size - 2, 1))]
        assert r.dictionary == pytest.approx(sum(g in known for g in grams) / len(grams))
        runs = sum(len(re.findall(p, v)) for p in ("[a-z]+", "[A-Z]+", "[0-9]+", "[^a-zA-Z0-9]+"))
        want = {"length": size, "n_lower": len(re.findall("[a-z]", v)) / size, "n_other": len(re.findall("[^a-zA-Z0-9]", v)) / size, "changes": (runs - 1) / size, "distinct_share": len(set(v)) / size, "next_length": 3}
        assert {k: r[k] for k in want} == pytest.approx(want)
        assert (r.named, r.assigned, r.quoted) == (float(n % 2 or n % 3 > 0), float(n % 2 or n % 3 > 0), float(n % 2))


def test_a_run_of_a_megabyte_is_described_in_seconds(spark):
    rows = spark.createDataFrame([(1, "key " + "abc123+/" * 131072 + " end", "a")], "doc_id bigint, text string, source string")
    started = time.monotonic()
    found = secret_scan.described(secret_scan.candidates(rows), spark.createDataFrame([("abc",)], "gram string")).first()
    assert found.length == 1 << 20 and found.dictionary == pytest.approx(1 / 8, rel=1e-3)
    assert time.monotonic() - started < 20


def test_without_labels_no_forest(spark, documents):
    found = secret_scan.described(secret_scan.candidates(documents), secret_scan.dictionary(documents))
    rows = secret_scan.scored(found, found.limit(0).withColumn("label", F.lit(1))).collect()
    assert rows and {r.probability for r in rows} == {0.5}
    one = secret_scan.scored(found, found.withColumn("label", F.lit(0))).collect()
    assert {r.is_secret for r in one} == {False}


def test_op3_has_no_python_on_its_path(spark, monkeypatch):
    plans, write = [], common.stage

    def noted(df, *rest):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, *rest)

    monkeypatch.setattr(common, "stage", noted)
    plans.append(queries.op3_forest_secrets(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString())
    assert len(plans) >= 5 and not any(word in plan for plan in plans for word in ("Python", "Pandas", "Arrow"))


def brute_format(chosen, rejected):
    shared = 0
    while shared < min(len(chosen), len(rejected)) and chosen[shared] == rejected[shared]:
        shared += 1
    parts = {"prompt": chosen[:shared], "chosen": chosen[shared:], "rejected": rejected[shared:]}
    out = {}
    for part, turns in parts.items():
        text, spans = "", []
        for role, said in turns:
            head = f"<|im_start|>{role}\n"
            if role == "assistant" and part != "prompt":
                spans.append([len(text) + len(head), len(text) + len(head) + len(said) + len("<|im_end|>")])
            text += head + said + "<|im_end|>\n"
        out[part] = (text, spans)
    return out


def test_preferences_against_brute_force(spark):
    rng = random.Random(6)
    pairs = {}
    for p in range(40):
        turns = [("system" if n == 0 else ("user", "assistant")[n % 2 == 0], f"turn {n} ünï{rng.randrange(3)}") for n in range(rng.randint(1, 6))]
        other = turns[: rng.randint(0, len(turns))] + [("assistant", f"else {rng.randrange(3)}")] * rng.randint(0, 2)
        pairs[p] = (turns, other)
    pairs[100] = ([("user", "q")] + [("assistant", str(n)) for n in range(2500)], [("user", "q")] + [("assistant", str(n)) for n in range(2400)] + [("user", "?")])
    pairs[101] = ([("user", "only chosen")], [])
    pairs[102] = ([("user", "same")], [("user", "same")])
    frame = lambda side: spark.createDataFrame([(p, n, *t) for p, both in pairs.items() for n, t in enumerate(both[side])], "pair_id bigint, turn bigint, role string, text string")
    got = {r.pair_id: r for r in chat_format.assembled(chat_format.formatted(frame(0), frame(1))).collect()}
    for p, (chosen, rejected) in pairs.items():
        expected = brute_format(chosen, rejected)
        assert got[p].prompt == expected["prompt"][0]
        for part in ("chosen", "rejected"):
            assert (got[p][part], got[p][f"{part}_mask"]) == tuple(expected[part]), (p, part)


def test_chat_awkward_rows(spark):
    kind = "pair_id bigint, turn bigint, role string, text string, seq int, start string"
    chosen = spark.createDataFrame([(1, 0, None, None, 1, "x"), (1, None, "user", "first", 1, "x"), (None, 0, "user", "no pair", 1, "x"), (2, 0, "user", "twice", 1, "x"), (2, 0, "user", "twice", 1, "x")], kind)
    rows = chat_format.formatted(chosen, chosen.where("pair_id = 1")).collect()
    one = [r for r in rows if r.pair_id == 1]
    assert [r.segment for r in sorted(one, key=lambda r: r.seq)] == ["<|im_start|>user\nfirst<|im_end|>\n", "<|im_start|>\n<|im_end|>\n"] and {r.part for r in one} == {"prompt"}
    assert [(r.part, r.start) for r in sorted(rows, key=lambda r: r.start) if r.pair_id == 2] == [("chosen", 0), ("chosen", 33)]
    assert chat_format.formatted(chosen.limit(0), chosen.limit(0)).collect() == []


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept, source = [], {r.doc_id: r.text for r in docs.collect()}
    for name, apply in corpus_pipeline.STAGES:
        docs = common.stage(apply(spark, docs, SF_DIR), common.scratch(spark, name))
        kept.append((name, collections.Counter(r.doc_id for r in docs.select("doc_id").collect())))
        if name != "bpe":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert [k[0] for k in kept] == ["quality_rules", "exact_dedup", "near_dedup", "mixing", "bpe"]
    for (_, before), (_, after) in zip(kept, kept[1:3]):
        assert set(after) <= set(before)
    assert set(kept[3][1]) <= set(kept[2][1]) and kept[4][1] == kept[3][1]
    texts = [source[i] for i in kept[1][1]]
    assert len({" ".join((t or "").split()) for t in texts}) == len(texts)
    from vulnlake.llm import bpe
    import public_tokenizers

    encoder = bpe.Encoder(bpe.load(public_tokenizers.path(bpe.VOCABULARY)))
    for r in docs.limit(20).collect():
        ids = encoder.encode([source[r.doc_id]])[0].tolist()
        assert r.ids == ids and r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_stages_on_awkward_rows(spark, documents, no_documents):
    for source in (documents, no_documents):
        docs = source
        for name, apply in corpus_pipeline.STAGES:
            docs = common.stage(apply(spark, docs, SF_DIR), common.scratch(spark, f"odd-{name}"))
            if name != "bpe":
                assert docs.columns == source.columns
