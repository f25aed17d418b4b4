"""Secret scan with a random forest that removes false positives.

A candidate is a run of at least ``LEAST`` key characters in a word; in a word without one, it is what follows a secret's
name and ``=`` or ``:``, from ``LEAST_NAMED`` characters on and of any letters, or what begins like a well-known key. It is
described by its length, its changes of
character class, its coverage by trigrams of the corpus's own common words, the rate of secrets where it was found
(``path``), and its neighbouring words. A random forest trained on labelled findings says how likely it is a secret.
Everything is DataFrame and SQL functions and the forest of Spark's own library.

Edge cases: null and empty texts have no candidates; candidates of any length are described whole; repeated rows give
repeated findings; a null path is a path of its own; without findings of both kinds no forest can be trained and the
probability is that of the labels (0.5 without any); an empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vulnlake.llm import common as C

LEAST = 16
LEAST_NAMED = 8
KEY_RUN = rf"([A-Za-z0-9+/_\-]{{{LEAST},}})"
NAMES = r"(?i)(token|secret|passw|pwd|api.?key|auth|bearer|credential|access.?key)"
#: What stands between a name and its value at the end of a word, and at a value's edges.
ASSIGNED = r"[=:][\"'`]?$"
EDGES = "\"'`,;()[]{}<>"
# How keys of well-known services begin.
KEY_FORMS = r"^(AKIA[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{20,}|github_pat_|glpat-|xox[abprs]-|AIza[A-Za-z0-9_\-]{30,}|sk_live_|rk_live_|sk-[A-Za-z0-9]{20,}|eyJ[A-Za-z0-9_\-]{10,})"
#: A word of the dictionary occurs in this share of all documents at least.
COMMON_SHARE = 0.001
#: Labelled findings the forest is trained on, at most: those with the smallest hashes.
TRAIN_ROWS = 20_000
FEATURES = [
    "length", "n_lower", "n_upper", "n_digit", "n_other", "changes", "vowel_runs", "hex_share", "distinct_share",
    "dictionary", "path_rate", "named", "assigned", "quoted", "next_length", "before_length",
]


def _value(word: Column, before: Column, name: Column) -> tuple[Column, Column]:
    """In a word without a key run: what stands before the value, and the value (null: none).

    The word may hold name and value (``password=...``) or the value alone, after a word that ends with ``=`` or ``:``.
    """
    inner = F.regexp_extract(word, rf"^(.*?[=:][\"'`]?)([^=:\"'`].{{{LEAST_NAMED - 1},}})$", 1)
    inside = (F.length(inner) > 0) & inner.rlike(NAMES)
    alone = before.rlike(ASSIGNED) & F.concat_ws(" ", name, before).rlike(NAMES)
    rest = F.when(inside, F.substring(word, F.length(inner) + 1, F.length(word))).when(alone | F.ltrim(word, F.lit(EDGES)).rlike(KEY_FORMS), word)
    value = F.btrim(rest, F.lit(EDGES))
    lead = F.when(inside, inner).otherwise(F.regexp_extract(word, rf"^([{_CLASS}]*)", 1))
    return lead, F.when(F.length(value) >= LEAST_NAMED, value)


_CLASS = "\"'`,;()\\[\\]{}<>"


def candidates(documents: DataFrame, path: str = "source") -> DataFrame:
    """Every candidate with the index of its word, what stands before it in the word, and the words around.

    ``prefix`` reaches back over the run before, if there is one, and no further.
    """
    words = F.split(F.coalesce("text", F.lit("")), f"[{C.WHITE}]+")
    at = lambda k: F.coalesce(F.get("words", k), F.lit(""))
    # Cheap tests on every word; what they let through is looked at closely below.
    worth = lambda w, i: (F.length(w) >= LEAST) | ((F.length(w) >= LEAST_NAMED) & (w.rlike("[=:]") | F.coalesce(F.get("words", i - 1), F.lit("")).rlike("[=:][\"'`]?$")))
    spotted = F.filter(F.transform("words", lambda w, i: F.when(worth(w, i), F.struct(i.alias("at"), w.alias("word")))), lambda x: x.isNotNull())
    spots = documents.select("doc_id", F.col(path).alias("path"), words.alias("words")).withColumn("spot", F.explode(spotted))
    spots = spots.select(
        "doc_id", "path", F.col("spot.at").alias("word_no"), F.col("spot.word").alias("word"),
        at(F.col("spot.at") - 2).alias("before2"), at(F.col("spot.at") - 1).alias("before1"), at(F.col("spot.at") + 1).alias("after"),
    )
    lead, value = _value(F.col("word"), F.col("before1"), F.col("before2"))
    runs = F.regexp_extract_all("word", F.lit(KEY_RUN), F.lit(1))
    gaps = F.split("word", KEY_RUN, -1)
    parted = spots.select("*", runs.alias("runs"), gaps.alias("gaps"), lead.alias("lead"), value.alias("only"))
    each = F.when(
        F.size("runs") > 0,
        F.transform("runs", lambda r, k: F.struct(F.concat(F.coalesce(F.get("runs", k - 1), F.lit("")), F.get("gaps", k)).alias("prefix"), r.alias("value"))),
    ).when(F.col("only").isNotNull(), F.array(F.struct(F.col("lead").alias("prefix"), F.col("only").alias("value"))))
    return parted.select("doc_id", "path", "word_no", "before2", "before1", "after", F.posexplode(each).alias("run_no", "c")).select(
        "doc_id", "path", "word_no", "before2", "before1", "after", "run_no", "c.*"
    )


def dictionary(documents: DataFrame, share: float = COMMON_SHARE) -> DataFrame:
    """Trigrams of the words that at least a ``share`` of all documents use; the share bounds how many there can be."""
    words = F.filter(F.array_distinct(F.split(F.coalesce("text", F.lit("")), f"[{C.WHITE}]+")), lambda w: F.length(w).between(3, 12))
    total = documents.count()
    counted = documents.select(F.explode(words).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    common = counted.where(F.col("n") >= max(2.0, share * total)).select(F.lower("word").alias("word")).where("word rlike '^[a-z]+$'")
    return common.select(F.explode(trigrams(F.col("word"))).alias("gram")).distinct()


def trigrams(text: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.greatest(F.length(text) - 2, F.lit(1))), lambda k: F.substring(text, k, F.lit(3)))


def _coverage(value: Column, known: bytes) -> Column:
    """Share of a text's trigrams that are known, in one pass over its letters. ``known``: a byte for every trigram."""
    number = F.transform(F.split(F.lower(value), ""), lambda c: F.ascii(c) - 97)
    codes = F.transform(number, lambda n: F.when((n >= 0) & (n < 26), n))
    n = F.greatest(F.length(value) - 2, F.lit(1))

    def hit(codes: Column, k: Column) -> Column:
        place = F.get(codes, k) * 676 + F.get(codes, k + 1) * 26 + F.get(codes, k + 2)
        return F.coalesce((F.substring(F.lit(known), place + 1, F.lit(1)) == F.lit(b"\x01")).cast("int"), F.lit(0))

    # Bound once: a lambda's argument is an array in memory, an expression would be computed for every letter.
    sums = F.transform(F.array(codes), lambda c: F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda total, k: total + hit(c, k)))
    return sums[0].cast("double") / n


def flags(grams: DataFrame) -> bytes:
    """The dictionary's trigrams as flags in the order of their letters: 17,576 bytes, whatever the corpus."""
    out = bytearray(26**3)
    for row in grams.where(F.col("gram").rlike("^[a-z]{3}$")).distinct().collect():
        one, two, three = (ord(c) - 97 for c in row["gram"])
        out[one * 676 + two * 26 + three] = 1
    return bytes(out)


def described(found: DataFrame, grams: DataFrame) -> DataFrame:
    """Features of candidates, but for ``path_rate``; all are linear in a candidate's length."""
    value, size = F.col("value"), F.length("value").cast("double")
    count = lambda pattern: F.regexp_count(value, F.lit(pattern)).cast("double")
    runs = count("[a-z]+") + count("[A-Z]+") + count("[0-9]+") + count("[^a-zA-Z0-9]+")
    around = F.concat_ws(" ", "before2", "before1", "prefix")
    return found.withColumns(
        {
            "dictionary": _coverage(value, flags(grams)),
            "length": size,
            "n_lower": count("[a-z]") / size,
            "n_upper": count("[A-Z]") / size,
            "n_digit": count("[0-9]") / size,
            "n_other": count("[^a-zA-Z0-9]") / size,
            "changes": (runs - 1) / size,
            "vowel_runs": count("(?i)[aeiou]+") / size,
            "hex_share": count("[0-9a-f]") / size,
            "distinct_share": F.size(F.array_distinct(F.split(value, ""))) / size,
            "named": around.rlike(NAMES).cast("double"),
            "assigned": (F.col("prefix").rlike("[=:]") | F.col("before1").rlike(ASSIGNED)).cast("double"),
            "quoted": F.col("prefix").rlike("[\"'`]$").cast("double"),
            "next_length": F.length("after").cast("double"),
            "before_length": F.length("before1").cast("double"),
        }
    )


def scored(findings: DataFrame, labelled: DataFrame, rows: int = TRAIN_ROWS, seed: int = 7) -> DataFrame:
    """``findings`` (described) with ``probability`` and ``is_secret``, by a forest trained on ``labelled``.

    ``labelled`` is described findings with ``label`` (1 secret, 0 false positive); at most ``rows`` of them are used.
    """
    total = labelled.count()
    share = min(1.0, rows / max(1, total))
    train = C.stage(labelled.where(C.fraction("doc_id", "word_no", "run_no", seed="forest") <= share).limit(rows), C.scratch(findings.sparkSession, "labelled"))
    overall = train.agg(F.avg("label")).first()[0]
    rates = train.groupBy("path").agg(((F.sum("label") + 10 * F.lit(overall)) / (F.count(F.lit(1)) + 10)).alias("path_rate"))

    def with_rate(df: DataFrame) -> DataFrame:
        met = df.join(rates.withColumnRenamed("path", "_path"), F.col("path").eqNullSafe(F.col("_path")), "left").drop("_path")
        return met.withColumn("path_rate", F.coalesce("path_rate", F.lit(overall), F.lit(0.5)).cast("double"))

    if train.select("label").distinct().count() < 2:
        return with_rate(findings).withColumn("probability", F.coalesce(F.lit(overall), F.lit(0.5)).cast("double")).withColumn("is_secret", F.col("probability") >= 0.5)
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep")
    forest = RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=24, maxDepth=6, seed=seed)
    model = forest.fit(assembler.transform(with_rate(train).withColumn("label", F.col("label").cast("double"))))
    out = model.transform(assembler.transform(with_rate(findings)))
    out = out.withColumn("probability", vector_to_array("probability")[1]).drop("features", "rawPrediction", "prediction")
    return out.withColumn("is_secret", F.col("probability") >= 0.5)


def rule_label() -> Column:
    """Labels of findings for tables that have none, by rules that say nothing of most findings (null).

    Secrets: well-known key forms, and values of mixed letters and digits given to a secret's name. False positives:
    values that neither stand at a name nor are assigned and are words for the most part or of one kind of letters.
    """
    known = F.col("value").rlike(KEY_FORMS)
    mixed = F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Za-z]")
    beside = (F.col("named") == 1.0) | (F.col("assigned") == 1.0)
    plain = (F.col("dictionary") >= 0.5) | ~mixed
    return (
        F.when(known | (mixed & (F.col("named") == 1.0) & (F.col("assigned") == 1.0)), F.lit(1))
        .when(~beside & plain, F.lit(0))
    )
