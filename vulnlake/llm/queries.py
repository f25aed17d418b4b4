"""The registered queries of the operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vulnlake.llm import alignment, bpe, chat_format, common, decontamination, exact_dedup, license_scan, merkle, mixing, near_dedup, quality_rules, secret_scan, sharding, warc

SHARDS = 40
SHARD_SEED = "shard"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_soft_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posterior, rate and copies of every document under the target mixture of the labelled domains."""
    rows = mixing.mixed(table(spark, sf_dir, "documents"), mixing.domains_of(table(spark, sf_dir, "labels")), mixing.MIXTURE)
    return rows.select("doc_id", "tokens", "posterior", "rate", "copies", "unmet")


def op2_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of nearly equal counts, each with the mixture of sources of the whole table."""
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", "source", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    placed = sharding.interleave(rows, "source", ["doc_id", "text_crc32", "size"], SHARDS, SHARD_SEED)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source"
    )


def op3_forest_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All secret candidates of all documents with the forest's verdict; values are given as digests only.

    Labelled findings are those in documents of the labelled table that a rule labels; the others are left out of the fit.
    """
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    found = common.stage(secret_scan.candidates(documents), common.scratch(spark, "candidates"))
    grams = common.stage(secret_scan.dictionary(documents), common.scratch(spark, "dictionary"))
    findings = common.stage(secret_scan.described(found, grams), common.scratch(spark, "findings"))
    known = table(spark, sf_dir, "labels").select("doc_id").distinct()
    labelled = findings.join(known, "doc_id", "left_semi").withColumn("label", secret_scan.rule_label()).where(F.col("label").isNotNull())
    out = secret_scan.scored(findings, labelled)
    return out.select(
        "doc_id", "word_no", "run_no", "path", F.length("value").alias("value_length"), F.sha2("value", 256).alias("value_sha256"),
        "dictionary", "named", "assigned", F.round("probability", 6).alias("probability"), "is_secret",
    )


def op4_digest_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies by the digest index, filled in two batches: the lower half of the ids, then the rest."""
    rows = common.stage(exact_dedup.digests(table(spark, sf_dir, "documents")), common.scratch(spark, "digests"))
    index = exact_dedup.DigestIndex(spark, common.scratch(spark, "digest-index"), buckets=32)
    span = rows.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    middle = ((span["low"] or 0) + (span["high"] or 0)) // 2
    older = F.coalesce(F.col("doc_id") <= middle, F.lit(False))
    index.add(0, rows.where(older))
    index.add(1, rows.where(~older))
    return index.decide(rows).select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op5_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations as preference pairs against their garbled last answers: prompt and masked completions, a row per turn."""
    chosen, rejected = chat_format.against_garbled(table(spark, sf_dir, "conversations"))
    return chat_format.formatted(chosen, rejected)


def op6_diagonal_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases and license templates in all documents."""
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op7_gzip_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to whole-stream archives, normalised to a member per record, and read back by offset."""
    folder = common.scratch(spark, "warc")
    rows = warc.assigned(table(spark, sf_dir, "pages"))
    whole = common.stage(warc.written(rows, f"{folder}/whole"), f"{folder}/whole-manifest")
    single = common.stage(warc.normalised(warc.spread(whole), f"{folder}/members"), f"{folder}/members-manifest")
    return warc.read_back(warc.spread(single)).drop("url")


def op8_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of all documents, judged by the newest policy."""
    rows = common.stage(quality_rules.ledger(table(spark, sf_dir, "documents")), common.scratch(spark, "ledger"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality_rules.accepted(F.col("bits"), 1)).alias("base_failed"),
        quality_rules.accepted(F.col("bits"), max(quality_rules.POLICIES)).alias("kept"),
        "bits",
    )


def op9_super_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: three words, a similarity of 0.85 or more."""
    return near_dedup.near_groups(table(spark, sf_dir, "documents"), "doc_id", "text", size=3, percent=85)


def op10_rank_array_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded again."""
    tables = bpe.share(spark, public_tokenizers.path(bpe.VOCABULARY))
    return bpe.round_trip(table(spark, sf_dir, "documents"), tables)


def op11_pointer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two tokenizers aligned in all documents, with corpus-wide counts of the linked id pairs."""
    tokenizers = alignment.share(spark, public_tokenizers.path(alignment.A_FILE), public_tokenizers.path(alignment.B_FILE))
    written = alignment.blocks(table(spark, sf_dir, "documents"), tokenizers)
    written = common.stage(written, common.scratch(spark, "alignment"), alignment.FILE_BLOCKS)
    return alignment.aligned(written).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


def op12_sibling_shift_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle manifest of all documents, a tree per source, and a check of every proof against partly altered texts."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    altered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    leaf = merkle.digest(*fields, F.col("text"))
    probe = F.when(altered, merkle.digest(*fields, F.translate("text", upper, lower)))
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", leaf.alias("leaf"), probe.alias("probe"))
    proofs = merkle.manifest(rows, "doc_id", "source", held=("probe",))
    found = proofs.withColumn("folded_root", merkle.folded(F.coalesce("probe", "leaf"), F.col("path")))
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op13_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in all documents: exact ones, and items nearly met (words up to two places off)."""
    index = common.stage(decontamination.built(table(spark, sf_dir, "documents")), common.scratch(spark, "positional-index"), decontamination.FILE_BLOCKS)
    rows = decontamination.judged(index, decontamination.phrases(table(spark, sf_dir, "benchmark")))
    return rows.select(
        F.col("key").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
        F.size("near").cast("long").alias("n_near"),
    )


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_soft_mixture, op2_interleaved_shards, op3_forest_secrets, op4_digest_index, op5_preference_format, op6_diagonal_votes, op7_gzip_normaliser, op8_rule_ledger, op9_super_minhash, op10_rank_array_bpe, op11_pointer_alignment, op12_sibling_shift_manifest, op13_positional_index)
}
