"""Mixing to target weights by soft membership.

A classifier trained on a labelled table gives every document a posterior over domains. Document rates ``w >= 0``
are then fitted so that the expected tokens of each domain, ``sum(w * tokens * posterior)``, match the targets, by
projected-gradient least squares: each step is one aggregate of a few numbers per domain over all documents, and
every document moves its own rate along the residual and is cut off at its least rate: one for documents of a domain
in ``KEEP`` (by their label, or else by their likeliest domain), zero for the others. The cut is part of every step, so
the other documents make up for what the kept ones hold of a domain that is to shrink. Steps are preconditioned by tokens (a
document's size) and by how the domains' totals answer to a step of the rows not held by their bound, one more aggregate,
so a few suffice. Rates start at one, and the
regularisation is the starting point: a document moves no further than the targets need. Each domain has to come near its own
target; ``unmet`` names those that could not, because the bounds do not allow it.

A rate is realised as ``floor(w)`` copies and one more with the probability of the rest, drawn from a hash of the id.

Edge cases: a null or empty text has no tokens, its rate stays at one; unlabelled rows are only predicted; labelled
ids without a document are ignored; repeated rows have equal rates; without any labelled row of two domains nothing
can be learned and every posterior is even; an empty table gives an empty result; extra columns are carried along.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vulnlake.llm import common as C

#: Words the classifier looks at, at most: those that tell the labelled domains apart best.
FEATURES = 4096
#: Labelled documents a word must occur in.
LEAST_DOCUMENTS = 4
#: Labelled documents the classifier is fitted on, at most: those with the smallest hashes of the id.
TRAIN_ROWS = 20_000
WRITE_EVERY = 8
STEPS = 60
#: A target is met within this share of itself, or of ``LEAST_TARGET`` tokens if it is smaller.
TOLERANCE = 5e-3
LEAST_TARGET = 1.0
#: So many steps without a gain of this share end the fit.
STALLED = 6
STALL_GAIN = 0.01
#: The registered mixture: target tokens of each domain as a multiple of what it has.
MIXTURE = {"clean": 1.1, "low": 0.5, "toxic": 0.1}
#: Domains whose documents each stay at least once.
KEEP = ("clean",)


@dataclass
class Classifier:
    domains: list[str]
    vocabulary: CountVectorizerModel | None
    model: LogisticRegressionModel | None

    def posteriors(self, rows: DataFrame) -> DataFrame:
        """``worded`` rows with ``posterior``, an array in the order of ``domains``, in place of the words."""
        if self.model is None:
            even = F.array(*[F.lit(1.0 / max(1, len(self.domains)))] * len(self.domains)).cast("array<double>")
            return rows.withColumn("posterior", even).drop("_words")
        out = self.model.transform(self.vocabulary.transform(rows).drop("_words"))
        return out.withColumn("posterior", vector_to_array("probability")).drop("features", "rawPrediction", "probability", "prediction")


def words(text: Column) -> Column:
    """Runs of letters and digits, and runs of other signs, of the lower-cased text."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"([\p{L}\p{N}]+|[^\p{L}\p{N}\s]+)"), F.lit(1))


def worded(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with its words and ``tokens``, their number."""
    return df.withColumn("_words", words(F.col(text))).withColumn("tokens", F.size("_words").cast("double"))


def telling_words(train: DataFrame, domains: int) -> list[str]:
    """The words of ``train`` (``label``, ``_words``) whose presence speaks most for or against one domain."""
    sizes = {int(r["label"]): r["count"] for r in train.groupBy("label").count().collect()}
    whole = sum(sizes.values())
    seen = train.select("label", F.explode(F.array_distinct("_words")).alias("word"))
    counts = seen.groupBy("word").agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("label") == k).alias(f"n{k}") for k in range(domains)])

    def weight(k: int) -> Column:
        inside, outside = F.col(f"n{k}"), F.col("n") - F.col(f"n{k}")
        own, rest = sizes.get(k, 0), whole - sizes.get(k, 0)
        ratio = F.log(((inside + 0.5) / (own + 1.0)) / ((outside + 0.5) / (rest + 1.0)))
        return F.abs(ratio) * F.greatest(inside, outside * own / max(rest, 1))

    best = counts.where(F.col("n") >= LEAST_DOCUMENTS).withColumn("weight", F.greatest(*[weight(k) for k in range(domains)]))
    return [r["word"] for r in best.orderBy(F.desc("weight"), "word").limit(FEATURES).select("word").collect()]


def fit(documents: DataFrame, labelled: DataFrame, rows: int = TRAIN_ROWS, seed: str = "train") -> Classifier:
    """Fit on ``labelled`` (``doc_id``, ``domain``), on at most ``rows`` of them.

    The bound is a cut of the id's hash at the share that ``rows`` has of all labelled rows, and a limit behind it.
    """
    known = labelled.where(F.col("domain").isNotNull() & F.col("doc_id").isNotNull())
    counts = {r["domain"]: r["count"] for r in known.groupBy("domain").count().collect()}
    domains = sorted(counts)
    if len(domains) < 2:
        return Classifier(domains, None, None)
    share = min(1.0, rows / sum(counts.values()))
    some = known.where(F.col("doc_id").isNotNull() & (C.fraction("doc_id", seed=seed) <= share)).limit(rows)
    number = F.array_position(F.array(*[F.lit(d) for d in domains]), F.col("domain")).cast("double") - 1
    some = C.stage(some.select("doc_id", number.alias("label")), C.scratch(documents.sparkSession, "train-ids"))
    train = documents.select("doc_id", "text").join(some, "doc_id")
    train = C.stage(worded(train).select("label", "_words"), C.scratch(documents.sparkSession, "train"))
    chosen = telling_words(train, len(domains))
    if not chosen:
        return Classifier(domains, None, None)
    vocabulary = CountVectorizerModel.from_vocabulary(chosen, inputCol="_words", outputCol="features", minTF=0.0).setBinary(True)
    model = LogisticRegression(maxIter=60, regParam=1e-3, family="multinomial").fit(vocabulary.transform(train).drop("_words"))
    return Classifier(domains, vocabulary, model)


def least_rates(rows: DataFrame, labelled: DataFrame, domains: list[str], keep: tuple[str, ...] = KEEP) -> DataFrame:
    """``rows`` with ``least``, the bound of their rate: one where the label, or else the likeliest domain, is in ``keep``.

    An id labelled more than once is kept if one of its labels says so; a tie for the likeliest domain counts as kept.
    """
    known = labelled.where(F.col("domain").isNotNull() & F.col("doc_id").isNotNull())
    said = known.groupBy(F.col("doc_id").alias("_labelled")).agg(F.max(F.col("domain").isin(list(keep)).cast("int")).alias("_said"))
    likely = [F.col("posterior")[k] >= F.array_max("posterior") for k, name in enumerate(domains) if name in keep]
    guess = F.greatest(F.lit(0), *[x.cast("int") for x in likely]) if likely else F.lit(0)
    joined = rows.join(said, F.col("doc_id") == F.col("_labelled"), "left")
    return joined.withColumn("least", F.coalesce("_said", guess).cast("double")).drop("_labelled", "_said")


def misses(totals: list[float], targets: list[float]) -> np.ndarray:
    """How far each domain is from its target, as a share of it; a target below a token counts as one token."""
    return np.abs(np.array(totals, float) - np.array(targets, float)) / np.maximum(np.array(targets, float), LEAST_TARGET)


def fit_rates(rows: DataFrame, targets: list[float], steps: int = STEPS, tolerance: float = TOLERANCE) -> tuple[DataFrame, list[list[float]]]:
    """Rates of ``rows`` (with ``tokens`` and ``posterior``) whose expected domain tokens match ``targets``.

    No rate falls below the row's ``least`` (zero where ``rows`` has no such column).

    Also returns the domain totals at every step, the last those of the rates returned; :func:`misses` says how near
    they are. It ends when every domain is within ``tolerance`` of its own target, after ``steps``, or when ``STALLED`` steps
    have brought no gain, as when the bounds rule a target out. A rate is a function of the residuals so far, so steps are chained as an expression; after
    ``WRITE_EVERY`` of them the rates are written, so the expression stays short and a lost executor costs little.
    """
    d = len(targets)
    folder = C.scratch(rows.sparkSession, "rates")
    rows = rows.withColumn("rate", F.lit(1.0))
    if not d:
        return rows, [[]]
    has = F.col("tokens") > 0
    least = F.col("least") if "least" in rows.columns else F.lit(0.0)
    held = lambda k: F.col("tokens") * F.col("posterior")[k]
    total = lambda value: F.coalesce(F.sum(value), F.lit(0.0))

    def totals(frame: DataFrame) -> np.ndarray:
        return np.array(frame.agg(*[total(F.col("rate") * held(k)) for k in range(d)]).first(), float)

    def curvature(frame: DataFrame, residual: np.ndarray) -> np.ndarray:
        """How the totals answer to a step, by the rows whose rates can follow it."""
        pushed = sum((F.col("posterior")[k] * float(residual[k]) for k in range(d)), F.lit(0.0))
        free = ((F.col("rate") > least) | (pushed < 0)).cast("double")
        flat = frame.agg(*[total(free * held(i) * F.col("posterior")[j]) for i in range(d) for j in range(d)]).first()
        return np.array(flat, float).reshape(d, d)

    goal, history, best, since, factor = np.array(targets, float), [], np.inf, 0, 1.0
    now = totals(rows)
    for n in range(steps):
        history.append(now.tolist())
        worst = float(misses(now, targets).max())
        if worst <= tolerance:
            return rows, history
        since = 0 if worst < best * (1 - STALL_GAIN) else since + 1
        factor = max(factor / 2, 1 / 16) if worst > best else min(1.0, factor * 2)
        best = min(best, worst)
        if since >= STALLED:
            return rows, history
        residual = now - goal
        h = curvature(rows, residual)
        pull = factor * np.linalg.solve(h + np.eye(d) * max(1e-9 * np.trace(h), 1e-9), residual)
        move = sum((F.col("posterior")[k] * float(pull[k]) for k in range(d)), F.lit(0.0))
        rows = rows.withColumn("rate", F.when(has, F.greatest(least, F.col("rate") - move)).otherwise(F.col("rate")))
        if n % WRITE_EVERY == WRITE_EVERY - 1:
            rows = C.stage(rows, f"{folder}/{n}")
        now = totals(rows)
    history.append(now.tolist())
    return rows, history


def copies(rate: Column, key: str, seed: str = "mix") -> Column:
    return (F.floor(rate) + (C.fraction(key, seed=seed) < rate - F.floor(rate)).cast("int")).cast("int")


def mixed(documents: DataFrame, labelled: DataFrame, shares: dict[str, float], train_rows: int = TRAIN_ROWS, keep: tuple[str, ...] = KEEP) -> DataFrame:
    """Per document: ``doc_id``, ``tokens``, ``posterior``, ``least``, ``rate`` and ``copies``; ``unmet`` names the domains off target, alike in all rows.

    ``shares`` gives each domain's target as a multiple of the tokens it has now (1 where not named); documents of the
    domains in ``keep`` stay at least once each.
    """
    classifier = fit(documents, labelled, train_rows)
    rows = classifier.posteriors(worded(documents.select("doc_id", "text")).drop("text"))
    rows = least_rates(rows, labelled, classifier.domains, keep)
    rows = C.stage(rows, C.scratch(documents.sparkSession, "posteriors"))
    d = len(classifier.domains)
    now = rows.agg(*[F.coalesce(F.sum(F.col("tokens") * F.col("posterior")[k]), F.lit(0.0)) for k in range(d)]).first() if d else []
    targets = [float(t) * shares.get(name, 1.0) for t, name in zip(now, classifier.domains)]
    fitted, history = fit_rates(rows, targets)
    off = [name for name, miss in zip(classifier.domains, misses(history[-1], targets)) if miss > TOLERANCE]
    if off:
        warnings.warn(f"mixture targets not met under the bounds: {off}", stacklevel=2)
    unmet = F.array(*[F.lit(name) for name in off]).cast("array<string>")
    return fitted.withColumn("copies", copies(F.col("rate"), "doc_id")).withColumn("unmet", unmet)


def domains_of(labels: DataFrame) -> DataFrame:
    """Domains of the labelled table: toxic, low or clean; of repeated labels of an id the most severe."""
    kind = F.when(F.max("toxic") == 1, "toxic").when(F.min("quality") == 0, "low").otherwise("clean")
    return labels.groupBy("doc_id").agg(kind.alias("domain"))
