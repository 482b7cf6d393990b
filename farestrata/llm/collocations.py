"""Collocations per language by dynamic itemset counting.

Documents are dealt into shards by hash and scanned in a cycle. Words are counted from the first scan; a phrase of two or
three words is counted from the first scan before which both phrases that it is made of (without its last and without its first word)
had reached the threshold, and until it has seen every shard once, so lengths are counted side by side. A counter's sum is
then exact, whenever it began.

**Activation.** What has reached the threshold is kept in a Bloom filter per length whose cells hold the scan before which they were set, so one
look tells whether and since when a phrase is active. A phrase that passes by chance is only counted in vain. Filters have a cell
for every 32 bytes of text, up to ``bloom.MOST_BITS >> 3`` cells (128 MiB); beyond that more is counted in vain.

**Counters** are a bucketed table: a scan counts in tasks, sums by one shuffle and appends; sums over scans need no shuffle,
and a phrase that just began needs none.
No candidate list, vocabulary or count passes through the driver, only filters.

**Score.** For every cut of a phrase ``floor(1000000 * a * a / (l * r))`` in exact decimals; the least counts, ties to the first cut.
A phrase that lies in a longer candidate with at least half of its count is dropped. Of each language the first ``top``
are chosen in two steps, so a large one isn't sorted in one task.

Texts are lower-cased (A-Z), cut at ``.,;:!?`` and the control characters 0x0A to 0x0D, and words are what spaces and tabs part.
NULL texts are empty, a NULL language is ``und``. Ties in score and count are broken by the phrase's UTF-8 bytes. Repeated rows count
again. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farestrata.llm import bloom
from farestrata.llm.common import map_arrow, stored

THRESHOLD, LONGEST, TOP = 10, 3, 2_000
SHARDS = 2
UNKNOWN = "und"
PARTS = 256
NEVER = 255

# --- words of a buffer, without a Python object per word -----------------------------------------------------------------

_WORD, _SPACE, _BREAK = 0, 1, 2
KIND = np.zeros(256, np.uint8)
KIND[list(b" \t")] = _SPACE
KIND[list(b".,;:!?\n\x0b\x0c\r")] = _BREAK
LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
BREAKS = re.compile(rb"[.,;:!?\n-\r]")
CHUNK = 16 << 20


def chunks(texts: pa.Array) -> Iterator[bytes]:
    """The texts one after the other, parted by line feeds, in pieces of about ``CHUNK`` bytes that end where a text is cut anyway."""
    whole = pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), texts.fill_null("").cast(pa.binary()))
    joined = memoryview(pc.binary_join(whole, b"\n")[0].as_buffer())
    start = 0
    while start < len(joined):
        found = BREAKS.search(joined, min(start + CHUNK, len(joined)))
        end = found.end() if found else len(joined)
        yield joined[start:end]
        start = end


def split_words(raw) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, the number of each word's entry among them, and the number of its piece."""
    text = LOWER[np.frombuffer(raw, np.uint8)]
    kinds = KIND[text]
    inside = np.concatenate(([False], kinds == _WORD, [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    offsets = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int32)
    letters = np.ascontiguousarray(text[inside[1:-1]])
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    coded = words.dictionary_encode()
    pieces = np.searchsorted(np.flatnonzero(kinds == _BREAK), starts)
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), pieces


# --- filters ------------------------------------------------------------------------------------------------------------


def word_hashes(lang: str, words) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode())
    return np.fromiter((xxhash.xxh64_intdigest(word, seed) for word in words), np.uint64, len(words))


def pair_hashes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of two-word phrases from those of their words."""
    mixed = left * np.uint64(0x9E3779B97F4A7C15) + right
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(29))


def since(cells: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The scan from which each phrase is active, ``NEVER`` if it isn't."""
    return cells[bloom.cells(hashes, len(cells))].max(axis=1)


def activate(cells: np.ndarray, reached: DataFrame, length: int, scan: int) -> None:
    """Set the phrases of ``reached`` (``lang, phrase``) active from ``scan``; cells that are set stay."""
    size = len(cells)

    def run(batches) -> Iterator[tuple[list, ...]]:
        bits = bloom.empty(size)
        for batch in batches:
            langs, phrases = batch.column(0), batch.column(1)
            for lang in langs.unique().to_pylist():
                own = phrases.filter(pc.equal(langs, lang)).cast(pa.binary())
                split = pc.split_pattern(own, b" ").flatten().to_numpy(zero_copy_only=False).reshape(-1, length)
                hashes = [word_hashes(lang, split[:, i]) for i in range(length)]
                bloom.put(bits, bloom.cells(reduce(pair_hashes, hashes), size))
        yield from bloom.segments(bits)

    touched = map_arrow(reached.select("lang", "phrase"), run, "segment int, bits binary")
    bits, = bloom.united(touched, lambda left, right: [left[0] | right[0]], size)
    cells[(np.unpackbits(bits, bitorder="little") == 1) & (cells == NEVER)] = scan


# --- scans --------------------------------------------------------------------------------------------------------------


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, where each is found first, and how often."""
    return np.unique(keys, return_index=True, return_counts=True)


def counted(raw, lang: str, scan: int, shards: int, active: dict[int, np.ndarray]) -> Iterator[tuple]:
    """``words, phrase, since, n`` of what a scan counts in a buffer; length 0 counts all words."""
    distinct, words, pieces = split_words(raw)
    if not len(words):
        return
    if scan < shards:
        yield 0, pa.array([""]), np.zeros(1, np.int16), np.array([len(words)])
        yield 1, distinct.cast(pa.string()), np.zeros(len(distinct), np.int16), np.bincount(words, minlength=len(distinct))
    if not active or len(words) < 2:
        return
    hashes = word_hashes(lang, distinct.to_pylist())
    own = since(active[1], hashes)
    begun = np.maximum(own[words[:-1]], own[words[1:]])
    begun[pieces[:-1] != pieces[1:]] = NEVER

    def counting(start: np.ndarray) -> np.ndarray:
        """Where phrases are that are active and have not seen this shard yet."""
        return np.flatnonzero((start <= scan) & (start.astype(np.int16) > scan - shards))

    def text(*places: np.ndarray) -> pa.Array:
        parts = [distinct.take(pa.array(words[place])) for place in places]
        return pc.binary_join_element_wise(*parts, b" ").cast(pa.string())

    at = counting(begun)
    if len(at):
        _, first, n = _distinct(words[at] * len(distinct) + words[at + 1])
        at = at[first]
        yield 2, text(at, at + 1), begun[at].astype(np.int16), n
    # pairs that are active at all may begin phrases of three words
    known = np.full(len(begun), NEVER, np.uint8)
    near = np.flatnonzero(begun <= scan)
    known[near] = since(active[2], pair_hashes(hashes[words[near]], hashes[words[near + 1]]))
    begun = np.maximum(known[:-1], known[1:])
    at = counting(begun)
    if len(at):
        pairs, whole = np.unique(words[at] * len(distinct) + words[at + 1], return_inverse=True)
        _, first, n = _distinct(whole * len(distinct) + words[at + 2])
        at = at[first]
        yield 3, text(at, at + 1, at + 2), begun[at].astype(np.int16), n


def scanned(docs: DataFrame, scan: int, shards: int, active: dict[int, np.ndarray]) -> DataFrame:
    """``words, lang, phrase, since, n`` counted in tasks, from rows of ``lang, text``."""
    shipped = docs.sparkSession.sparkContext.broadcast(active)

    def run(batches) -> Iterator[tuple]:
        for batch in batches:
            langs = batch.column(0)
            for lang in langs.unique().to_pylist():
                for raw in chunks(batch.column(1).filter(pc.equal(langs, lang))):
                    for length, phrases, begun, n in counted(raw, lang, scan, shards, shipped.value):
                        yield (pa.array(np.full(len(n), length, np.int8)), pa.array([lang]).take(pa.array(np.zeros(len(n), np.int32))),
                               phrases, pa.array(begun), pa.array(n))

    return map_arrow(docs, run, "words tinyint, lang string, phrase string, since smallint, n bigint")


class Counters:
    """The counters so far: a table bucketed by phrase, with a folder per length."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"phrase_counters_{uuid.uuid4().hex}"

    def append(self, found: DataFrame) -> None:
        # length and begin follow from the phrase; a sum stays in the bucket of its partition
        summed = found.groupBy("lang", "phrase").agg(
            F.max("words").alias("words"), F.max("since").alias("since"), F.sum("n").alias("n")
        )
        (
            summed.write.mode("append").format("parquet").partitionBy("words")
            .bucketBy(self.buckets, "lang", "phrase").saveAsTable(self.name)
        )

    def reached(self, length: int, scan: int, shards: int, threshold: int) -> DataFrame:
        """``lang, phrase, since, n`` of the phrases that are not yet counted whole, or are since this scan, and have reached the threshold."""
        rows = self.spark.table(self.name).where(F.col("words") == length).select("lang", "phrase", "since", "n")
        if length == 1:
            begun, new = F.lit(scan > 0), F.lit(scan == 0)
        else:
            begun, new = F.col("since").between(scan - shards + 1, scan - 1), F.col("since") == scan
        older = rows.where(begun).groupBy("lang", "phrase", "since").agg(F.sum("n").alias("n"))
        # what began with this scan has one row
        return rows.where(new & (F.col("n") >= threshold)).union(older.where(F.col("n") >= threshold))

    def close(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def frequent_phrases(
    docs: DataFrame, threshold: int = THRESHOLD, shards: int = SHARDS, lang_col: str = "lang", text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """``lang, words, phrase, n`` of all phrases found often enough, and ``lang, n`` of all words; both stored."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(lang_col, F.lit(UNKNOWN)).alias("lang"), F.coalesce(text_col, F.lit("")).alias("text"))
    shard = F.pmod(F.xxhash64("lang", "text"), F.lit(shards))
    text_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    size = min(max(1 << (text_bytes // 32).bit_length(), bloom.LEAST_BITS), bloom.MOST_BITS >> 3)
    active = {length: np.full(size, NEVER, np.uint8) for length in range(1, LONGEST)}
    counters, done = Counters(spark), []
    try:
        for scan in range(LONGEST * shards):
            # phrases of a length begin with those of the length below, which end a cycle earlier
            begun = [length for length in range(1, LONGEST) if (active[length] <= scan).any() and
                     (active[length][active[length] <= scan] > scan - shards).any()]
            if scan >= shards and not begun:
                break
            own = rows.where(shard == scan % shards)
            counters.append(scanned(own, scan, shards, active if scan else {}))
            for length in range(1, LONGEST + 1):
                if length > 1 and length - 1 not in begun or length == 1 and scan >= shards:
                    continue
                reached = stored(counters.reached(length, scan, shards, threshold), "phrases-reached")
                ended = F.col("since") == scan - shards + 1 if length > 1 else F.lit(scan == shards - 1)
                done.append(reached.where(ended).select("lang", F.lit(length).alias("words"), "phrase", "n"))
                if length < LONGEST:
                    activate(active[length], reached, length, scan + 1)
        phrases = stored(reduce(DataFrame.union, done), "phrases")
        words = spark.table(counters.name).where("words = 0").groupBy("lang").agg(F.sum("n").alias("n"))
        return phrases, stored(words, "phrase-words")
    finally:
        counters.close()


# --- score --------------------------------------------------------------------------------------------------------------


def scored(phrases: DataFrame) -> DataFrame:
    """``lang, words, phrase, a, l, r, score`` of all candidates: the cut with the lowest score."""
    candidates = phrases.where("words > 1").select("lang", "words", "phrase", F.col("n").alias("a"))
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "*",
        F.expr("substring_index(phrase, ' ', k)").alias("front"),
        F.expr("substring_index(phrase, ' ', k - words)").alias("back"),
    )
    left = phrases.select(F.col("lang").alias("l_lang"), F.col("phrase").alias("l_phrase"), F.col("n").alias("l"))
    right = phrases.select(F.col("lang").alias("r_lang"), F.col("phrase").alias("r_phrase"), F.col("n").alias("r"))
    both = stored(
        cuts.join(left, (F.col("lang") == F.col("l_lang")) & (F.col("front") == F.col("l_phrase")))
        .select("lang", "words", "phrase", "a", "k", "back", "l"),
        "phrase-cuts",
    ).join(right, (F.col("lang") == F.col("r_lang")) & (F.col("back") == F.col("r_phrase")))
    exact = {name: f"cast({name} as decimal(16,0))" for name in ("a", "l", "r")}
    score = F.expr(f"cast((1000000BD * {exact['a']} * {exact['a']}) div ({exact['l']} * {exact['r']}) as bigint)")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return both.groupBy("lang", "words", "phrase", "a").agg(lowest).select("lang", "words", "phrase", "a", "cut.l", "cut.r", "cut.score")


def independent(candidates: DataFrame) -> DataFrame:
    """``candidates`` without those that lie in a longer one with at least half of their count."""
    inner = candidates.where(F.col("words") == LONGEST).select(
        F.col("lang").alias("i_lang"), F.col("a").alias("longer"),
        F.explode(F.array(F.substring_index("phrase", " ", LONGEST - 1), F.substring_index("phrase", " ", 1 - LONGEST))).alias("inside"),
    )
    most = inner.groupBy("i_lang", "inside").agg(F.max("longer").alias("longer"))
    covered = F.coalesce(100 * F.col("longer") >= 50 * F.col("a"), F.lit(False))
    return (
        candidates.join(most, (F.col("lang") == F.col("i_lang")) & (F.col("phrase") == F.col("inside")), "left")
        .where(~covered).drop("i_lang", "inside", "longer")
    )


def collocations(
    docs: DataFrame, threshold: int = THRESHOLD, top: int = TOP, shards: int = SHARDS,
    lang_col: str = "lang", text_col: str = "text",
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``top`` of each language."""
    phrases, words = frequent_phrases(docs, threshold, shards, lang_col, text_col)
    kept = independent(stored(scored(phrases), "phrase-scores"))
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the first of every part hold the first of all
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    first = kept.withColumn("part", part).withColumn("place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*best)))
    ranked = first.where(F.col("place") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)))
    return ranked.where(F.col("rank") <= top).join(words, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
