"""First-copy rules that hold up when one group of copies is a large part of the data.

A plain ``row_number`` window sends every copy of a group to one task. Here a group is reduced to its first
position before it crosses the network.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farestrata.session import shared_folder, tidy


#: Longs of the list of bits that says which hashes are repeated: 64 bits each, so 8 MB of bits at any data size.
WORDS = 2**20


def _word(hashed: Column, words: int = WORDS) -> Column:
    return hashed.bitwiseAND(F.lit(words - 1))


def _bit(hashed: Column) -> Column:
    return F.shiftrightunsigned(hashed, 58).cast("int")


def repeated_hashes(df: DataFrame, keys: list[str]) -> DataFrame:
    """The hashes that more than one row has, as bits: ``_word, _bits``, at most ``WORDS`` rows. A row sends its hash alone."""
    repeated = df.groupBy(F.xxhash64(*keys).alias("_hash")).agg(F.count("*").alias("_rows")).where("_rows > 1")
    return _as_bits(repeated, "_hash")


def _as_bits(hashes: DataFrame, name: str, words: int = WORDS) -> DataFrame:
    hashed = F.col(name)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), _bit(hashed))
    return hashes.groupBy(_word(hashed, words).alias("_word")).agg(F.bit_or(bit).alias("_bits"))


def suspects(df: DataFrame, keys: list[str]) -> DataFrame:
    """The rows that may share their ``keys`` with another: all that do (NULL equals NULL), and some whose bit another has.

    For tables whose keys are mostly unique and cheap to read twice: the bits are broadcast, and an exact step on these rows follows.
    """
    hashed = F.xxhash64(*keys)
    marked = df.join(F.broadcast(repeated_hashes(df, keys)), _word(hashed) == F.col("_word"))
    return marked.where(F.getbit("_bits", _bit(hashed)) == 1).select(*df.columns)


def repeated_groups(df: DataFrame, keys: list[str], position: str) -> DataFrame:
    """One row per group with more than one member: its keys and the first position.

    Reads only the keys and the position; partial aggregation folds a hot group inside each map task.
    """
    return (
        df.groupBy(*keys)
        .agg(F.min(position).alias("_first_position"), F.count("*").alias("_copies"))
        .where("_copies > 1")
        .drop("_copies")
    )


def flag_later_copies(df: DataFrame, repeated: DataFrame, keys: list[str], position: str, flag: str) -> DataFrame:
    """Add ``flag``: true on every member of a repeated group except the first; NULL keys match NULL keys.

    ``repeated`` holds one row per group, so this never multiplies rows. Spark broadcasts it when its measured
    size allows, else joins by shuffle, where skewed partitions of ``df`` are split at run time.
    """
    renamed = repeated.select(*[F.col(k).alias(f"_r_{k}") for k in keys], "_first_position")
    same = reduce(Column.__and__, [df[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys])
    later = F.coalesce(F.col(position) > F.col("_first_position"), F.lit(False))
    return (
        df.join(renamed, same, "left")
        .withColumn(flag, later)
        .drop("_first_position", *[f"_r_{k}" for k in keys])
    )


#: Repeated groups up to which their list is broadcast; an entry takes some 110 bytes.
MOST_BROADCAST_GROUPS = 4_000_000


def with_fingerprint(df: DataFrame, keys: list[str]) -> DataFrame:
    """Add 128 bits of the keys as ``_f1, _f2``. Which keys are NULL is hashed too, as a NULL alone leaves a hash as it is."""
    nulls = reduce(Column.__add__, [F.when(F.col(k).isNull(), 2**i).otherwise(0) for i, k in enumerate(keys)])
    return df.withColumns({"_f1": F.xxhash64(nulls, *keys), "_f2": F.xxhash64(F.lit("second"), *keys, nulls)})


def _words_for(groups: int) -> int:
    """Words with 16 bits for each group, so that one row in sixteen has the bit of a group by chance; 32 MB of bits at most."""
    words = WORDS
    while 64 * words < 16 * groups and words < 4 * WORDS:
        words *= 2
    return words


def mark_later_copies(
    df: DataFrame,
    keys: list[str],
    position: str,
    flag: str,
    keep: Callable[[DataFrame], DataFrame] | None = None,
    gather: str | None = None,
) -> DataFrame:
    """Find the repeated groups on the key columns alone, and flag their later members.

    Nothing runs before the result is asked for, and what ``df`` shuffles to get here is shuffled once, as both uses of it
    stand in one plan. Where ``df`` is cheap to read again, as a stored table is, ``keep`` (such as :func:`stored_groups`) may
    store the groups first, by 128-bit fingerprints of their keys. They are counted, and while they are no more than
    ``MOST_BROADCAST_GROUPS`` the list is broadcast, so the wide rows don't move at all. Beyond that a bit per group is broadcast: rows
    without one stay where they are, the others are joined by shuffle and, with ``gather``, gathered again by that column. That reads
    ``df`` once more.
    """
    if keep is None:
        return flag_later_copies(df, repeated_groups(df, keys, position), keys, position, flag)
    marked, prints = with_fingerprint(df, keys), ["_f1", "_f2"]
    groups = keep(repeated_groups(marked, prints, position))
    renamed = groups.select(F.col("_f1").alias("_r1"), F.col("_f2").alias("_r2"), "_first_position")
    same = (F.col("_f1") == F.col("_r1")) & (F.col("_f2") == F.col("_r2"))
    later = F.coalesce(F.col(position) > F.col("_first_position"), F.lit(False))
    columns = [F.col(f"`{c}`") for c in df.columns]

    def flagged(rows: DataFrame, listed: DataFrame) -> DataFrame:
        return rows.join(listed, same, "left").select(*columns, later.alias(flag))

    found = groups.count()
    if found <= MOST_BROADCAST_GROUPS:
        return flagged(marked, F.broadcast(renamed))
    words = _words_for(found)
    bits = F.broadcast(_as_bits(groups, "_f1", words))
    weighed = marked.join(bits, _word(F.col("_f1"), words) == F.col("_word"), "left")
    listed = F.coalesce(F.getbit("_bits", _bit(F.col("_f1"))) == 1, F.lit(False))
    moved = flagged(weighed.where(listed), renamed)
    stay = weighed.where(~listed).select(*columns, F.lit(False).alias(flag))
    return stay.union(moved.hint("rebalance", gather) if gather else moved)


def stored_groups(groups: DataFrame) -> DataFrame:
    """A short list written to the shared folder and read back."""
    spark = groups.sparkSession
    folder = f"{shared_folder(spark)}/repeated-{uuid.uuid4().hex}"
    with tidy(spark):
        groups.write.parquet(folder)
    return spark.read.schema(groups.schema).parquet(folder)
