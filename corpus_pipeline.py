"""Training corpus: clean, deduplicate, mix and encode the documents.

Each stage works on all that the one before kept, is written as Parquet and read again. All stages but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from farestrata.llm import bpe, exact_dedup, mixing, simhash, toxicity
from farestrata.llm.common import new_folder, stored, table
from farestrata.llm.queries import MAX_BITS, MIX_SEED, SHINGLE, TOKENIZER, TOXIC_LIMIT, WEIGHTS


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity limit, by a model learnt from the labelled documents."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model, TOXIC_LIMIT)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    index = exact_dedup.DigestIndex(spark, new_folder(spark, "digest-index"))
    try:
        return exact_dedup.deduplicate(docs, index)
    finally:
        index.close()


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints."""
    return simhash.keep_first(docs, SHINGLE, MAX_BITS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their shares; documents of scarce sources are repeated."""
    return mixing.mixed_documents(docs, WEIGHTS, MIX_SEED)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids``, the digest of the decoded ids and whether they give the text."""
    return bpe.encode_and_check(docs, TOKENIZER)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", clean),
    ("exact_dedup", drop_copies),
    ("simhash", drop_near_copies),
    ("mixing", mix),
    ("bpe", encode),
]

#: No SQL: toxicity is a trained model, and fingerprints need XXH64.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
