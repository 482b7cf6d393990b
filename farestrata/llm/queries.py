"""The registered queries of the corpus operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farestrata.llm import (
    bpe,
    collocations,
    conversations,
    exact_dedup,
    lines,
    mixing,
    quality,
    rules,
    sharding,
    simhash,
    suffix_dedup,
    toxicity,
    url_filters,
)
from farestrata.llm.common import held_out, new_folder, stored, table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
WEIGHTS = (5, 2, 1)
SHARDS = 16
SHARD_SEED, MIX_SEED = 7, 11
QUALITY_LIMIT, TOXIC_LIMIT = 0.3, 0.5
SHINGLE, MAX_BITS = 3, 3


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filters.judge_urls(table(spark, sf_dir, "pages"), known)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), SHARDS, SHARD_SEED)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"), WEIGHTS, MIX_SEED)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    known = stored(quality.counted(docs), "quality-terms")
    scored = quality.score(known, quality.learn(known, labels))
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= QUALITY_LIMIT).cast("int").alias("predicted"),
    )


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = exact_dedup.DigestIndex(spark, new_folder(spark, "digest-index"))
    try:
        return exact_dedup.judge(table(spark, sf_dir, "documents"), index)
    finally:
        index.close()


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = rules.apply_policy(rules.stored_ledger(table(spark, sf_dir, "documents")), "v2")
    base_failed = F.col("failed_rules").bitwiseAND(F.lit(rules.mask("base"))) != 0
    return entries.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), "kept", "failed_rules",
    )


def quality_rule_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.all_ablations(rules.stored_ledger(table(spark, sf_dir, "documents")))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.passages(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity.score(docs, toxicity.learn(docs, labels))
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= TOXIC_LIMIT).cast("int").alias("predicted"),
    )


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), TOKENIZER)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), SHINGLE, MAX_BITS)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversations.faults(conversations.damage(table(spark, sf_dir, "conversations")))
    return conversations.repair_digests(rows, conversations.verdicts(rows))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.drop_repeated_lines(table(spark, sf_dir, "documents"))
    digest = F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    return kept.select("doc_id", "n_lines", "n_dropped", digest)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_url_filters, op2_sharding, op3_mixing, op4_quality, op5_exact_dedup, op6_quality_rules,
            quality_rule_ablations, op7_suffix_dedup, op8_toxicity, op9_bpe, op10_simhash,
            op11_conversation_repair, op12_line_dedup, op13_collocations,
        )
    }
