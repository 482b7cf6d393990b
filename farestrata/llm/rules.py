"""Quality rules as a ledger of bits.

Every rule is evaluated once per document. The ledger keeps the measurements and one bit per broken rule, stored in the shared
folder; a policy is a versioned set of rules, applied afterwards to the stored rows without reading a text again. What each rule costs a policy follows from
the number of documents per bit pattern, of which there are at most two to the number of rules.

NULL and empty texts have no words and break ``few_words`` alone. Ties at a limit pass. Repeated rows give repeated
rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farestrata.llm.common import WORD, map_rows, stored

SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")

#: Rules in the order of their bits, as SQL conditions over the measurements that hold when the rule is broken.
RULES = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > word_chars",
    "repeated_lines": "2 * n_dup_lines > n_lines",
    "word_length": "n_words > 0 AND (word_chars > 20 * n_words OR word_chars < 2 * n_words)",
    "shouting": "2 * n_upper > word_chars",
}
BASE = ("few_words", "repeated_words")
#: Versions of policies; a new one is added, an old one never changes.
POLICIES = {
    "base": BASE,
    "v1": (*BASE, "symbols", "repeated_lines"),
    "v2": (*BASE, "symbols", "repeated_lines", "word_length", "shouting"),
}


def bit(rule: str) -> int:
    return 1 << list(RULES).index(rule)


def mask(policy: str) -> int:
    return sum(bit(rule) for rule in POLICIES[policy])


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of ``MEASURES``."""
    if not text:
        return (0,) * len(MEASURES)
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    repeated = 0
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) < len(windows):
        found, reach = Counter(windows), 0
        for at, window in enumerate(windows):
            if found[window] > 1:
                repeated += at + 3 - max(at, reach)
                reach = at + 3
    return (
        len(words),
        sum(map(len, words)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated,
        len(lines),
        sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")),
    )


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, all measurements and ``failed_rules``, the bits of the broken rules."""
    def run(batches) -> Iterator:
        for keys, texts in batches:
            rows = [measure(text) for text in texts]
            yield keys, *([row[i] for row in rows] for i in range(len(MEASURES)))

    kind = dict(docs.dtypes)[id_col]
    measured = map_rows(
        docs.select(id_col, text_col), run, f"`{id_col}` {kind}, " + ", ".join(f"{m} bigint" for m in MEASURES)
    )
    bits = " | ".join(f"if({broken}, {bit(rule)}L, 0L)" for rule, broken in RULES.items())
    return measured.withColumn("failed_rules", F.expr(bits))


def stored_ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """:func:`ledger`, written once; policies and ablations read the stored rows."""
    return stored(ledger(docs, id_col, text_col), "quality-ledger")


def breaks(policy: str) -> Column:
    return F.col("failed_rules").bitwiseAND(F.lit(mask(policy))) != 0


def apply_policy(entries: DataFrame, policy: str) -> DataFrame:
    return entries.withColumn("kept", ~breaks(policy))


def ablations(entries: DataFrame, policy: str) -> DataFrame:
    """Per rule of the policy: ``failed`` documents, ``alone`` (no other rule rejects them), ``kept_without`` it."""
    patterns = entries.groupBy("failed_rules").agg(F.count("*").alias("documents"))
    whole = mask(policy)
    bits = F.col("failed_rules")

    def total(condition: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("documents"))), F.lit(0)).alias(name)

    wide = patterns.agg(*[
        F.struct(
            F.lit(rule).alias("rule"),
            total(bits.bitwiseAND(F.lit(bit(rule))) != 0, "failed"),
            total(bits.bitwiseAND(F.lit(whole)) == bit(rule), "alone"),
            total(bits.bitwiseAND(F.lit(whole & ~bit(rule))) == 0, "kept_without"),
        ).alias(rule)
        for rule in POLICIES[policy]
    ])
    return wide.select(F.explode(F.array(*POLICIES[policy])).alias("row")).select("row.*")


def all_ablations(entries: DataFrame) -> DataFrame:
    """``policy`` and the rows of :func:`ablations`, for every policy."""
    found = [ablations(entries, policy).select(F.lit(policy).alias("policy"), "*") for policy in POLICIES]
    return reduce(DataFrame.unionAll, found)
