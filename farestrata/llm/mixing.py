"""Mixing sources to target weights with hash-threshold histograms.

Targets follow from the words per source alone. A source gives whole copies of itself as often as they fit its target
and a share of one more: the documents whose seeded hash lies below a threshold. The threshold is found without
sorting: words are summed per source and hash bucket, the bucket in which the running sum passes the budget is the
boundary, and only that bucket is split again, until a bucket is a single hash value. The hash is one of the id. Rows that
share the boundary's hash, as rows without an id or with a repeated one do, are told apart in the same way by a second hash, of the
text, and fully equal rows by number, so a sum misses its target by half a document at most. Thresholds nest, so a larger budget
takes every document of a smaller one, and the same seed always takes the same documents.

Sources rank by code point, NULL last, and take the weights in turn. NULL and empty texts have no words; they are
taken or left like others and change no sum. Of rows with equal id and text it is open which ones are taken, not how many. An
empty table gives an empty result. Other columns are untouched.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farestrata.llm.common import WORD_SQL, seeded_rank, stored

HASH_BITS = 60
#: Bits of the hash that one histogram tells apart; 60 is a multiple of it.
STEP_BITS = 15
MOST_COPIES = 3


def _text_rank(text_col: str, seed: int) -> Column:
    """60 bits that depend on the seed and the text alone."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(text_col), F.lit(""))).cast("binary")), 1, 15),
                  16, 10).cast("bigint")


def sized(docs: DataFrame, seed: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        F.coalesce(F.regexp_count(text_col, F.lit(WORD_SQL)), F.lit(0)).cast("bigint").alias("size"),
        seeded_rank(id_col, seed).alias("mixed"),
        _text_rank(text_col, seed).alias("text_mixed"),
    )


def targets(sizes: DataFrame, weights: tuple[int, ...], most: int = MOST_COPIES) -> DataFrame:
    """``source, source_size, target`` from rows of ``source, size``.

    All words are shared by weight; a source stops at ``most`` times its size and the rest is shared again. The
    sources that stop are those with the least size per weight, so running sums in that order find them at once. One
    row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size"))
    named = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(named) - 1) % len(weights) + 1)
    weighted = per.withColumn("weight", weight)
    tight = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = tight.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left = (F.sum("source_size").over(everything) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
    weights_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    stops = weighted.select("*", left.alias("left"), weights_left.alias("weights_left")).withColumn(
        "stops", F.col("left") * F.col("weight") > most * F.col("source_size") * F.col("weights_left")
    )
    # the first source that doesn't stop gives the level for all after it
    first = F.max(F.when(~F.col("stops"), F.col("weights_left"))).over(everything)
    levelled = stops.withColumn("first", first).withColumn(
        "level_left", F.max(F.when(F.col("weights_left") == F.col("first"), F.col("left"))).over(everything)
    )
    open_ = F.coalesce(F.col("weights_left") <= F.col("first"), F.lit(False))
    return levelled.select(
        "source",
        "source_size",
        F.when(open_, (F.col("level_left") * F.col("weight")).cast("double") / F.col("first").cast("double"))
        .otherwise((most * F.col("source_size")).cast("double")).alias("target"),
    )


def _narrowed(rows: DataFrame, state: DataFrame, hashed: str) -> DataFrame:
    """``state`` with ``prefix``, the value of ``hashed`` at which the budget of a source ends, and the ``budget`` left there.

    ``rows`` has ``source, size`` and ``hashed``; ``state`` has ``source, budget`` and one row per source. A source
    whose budget is not positive gets the prefix 0, before all rows.
    """
    state = state.withColumn("prefix", F.lit(0).cast("bigint"))
    for depth in range(HASH_BITS // STEP_BITS):
        below = HASH_BITS - STEP_BITS * (depth + 1)
        boundary = state.select(F.col("source").alias("b_source"), F.col("prefix").alias("b_prefix"), "budget")
        inside = rows.join(
            boundary,
            F.col("source").eqNullSafe(F.col("b_source"))
            & (F.shiftright(hashed, below + STEP_BITS) == F.col("b_prefix"))
            & (F.col("budget") > 0),
        )
        histogram = inside.groupBy("source", F.shiftright(hashed, below).alias("bucket")).agg(F.sum("size").alias("words"))
        running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        sums = histogram.withColumn("before", F.coalesce(F.sum("words").over(running), F.lit(0)))
        limits = sums.join(boundary, F.col("source").eqNullSafe(F.col("b_source"))).groupBy("source").agg(
            F.max(F.when(F.col("before") <= F.col("budget"), F.struct("bucket", "before"))).alias("edge")
        )
        edge = limits.select(F.col("source").alias("e_source"), "edge.*")
        joined = state.join(edge, F.col("source").eqNullSafe(F.col("e_source")), "left")
        found = F.col("bucket").isNotNull()
        state = stored(
            joined.withColumn("budget", F.when(found, F.col("budget") - F.col("before")).otherwise(F.col("budget")))
            .withColumn("prefix", F.when(found, F.col("bucket")).otherwise(F.shiftleft("prefix", STEP_BITS)))
            .select(*state.columns),
            "mix-state",
        )
    return state


def thresholds(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``source, source_size, target, copies, threshold, text_threshold, equals``.

    Documents with a hash below ``threshold`` are taken once more; of those at it, the ones whose text hash is below
    ``text_threshold``, and ``equals`` of the rows that have both, if that is some but not all of them. ``rows`` has ``source, size, mixed, text_mixed``;
    ``wanted`` is the output of :func:`targets`.
    """
    # whole copies, and the words still missing
    state = stored(
        wanted.select(
            "*",
            F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(1)
            .cast("int").alias("copies"),
        ).select("*", (F.col("target") - F.col("copies") * F.col("source_size")).alias("budget")),
        "mix-state",
    )
    state = _narrowed(rows, state, "mixed").withColumnRenamed("prefix", "threshold")
    edge = state.where("budget > 0").select(F.col("source").alias("b_source"), F.col("threshold").alias("b_threshold"))
    block = stored(
        rows.join(edge, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("mixed") == F.col("b_threshold")))
        .select("source", "size", "text_mixed"),
        "mix-block",
    )
    state = _narrowed(block, state, "text_mixed").withColumnRenamed("prefix", "text_threshold")
    # one text is left: as many of its rows go in as bring the sum nearest to the budget
    same = block.groupBy(F.col("source").alias("s_source"), "text_mixed").agg(
        F.max("size").alias("words"), F.count("*").alias("members"))
    joined = state.join(
        same, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("text_threshold") == F.col("text_mixed")), "left"
    )
    whole = F.floor(F.col("budget") / F.col("words"))
    nearest = F.least(whole + (2 * (F.col("budget") - whole * F.col("words")) > F.col("words")).cast("bigint"), F.col("members"))
    equals = F.when((F.col("budget") > 0) & (F.col("words") > 0), nearest).otherwise(0).cast("bigint")
    every = F.coalesce(F.col("equals") == F.col("members"), F.lit(False))
    return stored(
        joined.withColumn("equals", equals).select(
            "source", "source_size", "target", "copies", "threshold",
            (F.col("text_threshold") + every.cast("bigint")).alias("text_threshold"),
            F.when(every, F.lit(0).cast("bigint")).otherwise(F.col("equals")).alias("equals"),
        ),
        "mix-thresholds",
    )


def plan(
    docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), seed: int = 11,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> tuple[DataFrame, DataFrame]:
    """The stored sizes of all documents, and the thresholds of their sources (stored, one row per source)."""
    rows = stored(sized(docs, seed, id_col, text_col, source_col), "mix-sizes")
    wanted = stored(targets(rows, weights), "mix-targets")
    return rows, thresholds(rows, wanted)


def _with_copies(rows: DataFrame, limits: DataFrame, source_col: str, mixed, text_mixed) -> tuple[DataFrame, dict[str, str]]:
    """``rows`` with the columns of ``limits`` and ``times``, under names that no other column has."""
    names = {c: f"_{c}_{uuid.uuid4().hex}" for c in (*limits.columns, "times", "nth")}
    renamed = limits.select(*[F.col(c).alias(names[c]) for c in limits.columns])
    joined = rows.join(renamed, F.col(source_col).eqNullSafe(F.col(names["source"])))
    at_edge = mixed == F.col(names["threshold"])
    more = (mixed < F.col(names["threshold"])) | (at_edge & (text_mixed < F.col(names["text_threshold"])))
    counted = joined.withColumn(names["times"], F.col(names["copies"]) + more.cast("int"))
    if limits.where("equals > 0").isEmpty():
        return counted, names
    # rows of one id and text per source; only they are numbered
    equal = at_edge & (text_mixed == F.col(names["text_threshold"])) & (F.col(names["equals"]) > 0)
    numbered = counted.where(equal).withColumn(
        names["nth"], F.row_number().over(Window.partitionBy(names["source"]).orderBy(F.lit(1)))
    ).withColumn(names["times"], F.col(names["copies"]) + (F.col(names["nth"]) <= F.col(names["equals"])).cast("int"))
    return counted.where(~equal).union(numbered.drop(names["nth"])), names


def mixture(
    docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), seed: int = 11,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """``id, size, source_size, target, taken``: the words the mix takes of every document, repeats counted."""
    rows, limits = plan(docs, weights, seed, id_col, text_col, source_col)
    joined, names = _with_copies(rows, limits, "source", F.col("mixed"), F.col("text_mixed"))
    return joined.select(
        F.col("id").alias(id_col),
        "size",
        F.col(names["source_size"]).alias("source_size"),
        F.col(names["target"]).alias("target"),
        (F.col("size") * F.col(names["times"])).alias("taken"),
    )


def mixed_documents(
    docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), seed: int = 11,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """``docs`` as the mix takes them: rows left out are gone, rows taken more than once are repeated."""
    _, limits = plan(docs, weights, seed, id_col, text_col, source_col)
    joined, names = _with_copies(docs, limits, source_col, seeded_rank(id_col, seed), _text_rank(text_col, seed))
    times = F.col(names["times"])
    return joined.where(times > 0).withColumn(names["times"], F.explode(F.sequence(F.lit(1), times))).select(*docs.columns)
