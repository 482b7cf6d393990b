"""Shards that all match the mixture of sources: proportional stratified interleaving, with DataFrame functions only.

Rows get a seeded shuffle key, a rank by it within their source, and the fractional rank (2 * rank - 1) / (2 * rows of the
source). Ordered by that fraction, every stretch of rows holds the sources in proportion, so the order is cut into
shards of equal counts: shard sizes differ by one row at most.

No window spans a source or the table: ranks are counted inside buckets of the shuffle key (and of the fraction) and
shifted by the counts of the buckets before. Only ids, sources, sizes and checksums are shuffled, never texts.

The shuffle key is a hash of id, checksum and size, so rows that share an id, as rows without one do, spread over the buckets by their
texts; only rows equal in all three meet in one bucket.

NULL texts have no bytes; a NULL source is a source of its own; NULL ids are ordinary values. Ties are broken by id,
checksum and size; rows equal in all of them are interchangeable. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farestrata.llm.common import stored

#: Rows that one bucket should hold.
BUCKET_ROWS = 10_000
_HASH_SPAN = 1 << 60


def _bucket(share: Column, buckets: int) -> Column:
    return F.least(F.floor(share * F.lit(buckets)), F.lit(buckets - 1)).cast("int")


def _shuffle_key(seed: int) -> Column:
    """60 bits of the seed, the id, the checksum and the size, as DuckDB can compute them too."""
    parts = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("id").cast("string"), F.lit("null")), "text_crc32", "size")
    return F.conv(F.substring(F.md5(parts.cast("binary")), 1, 15), 16, 10).cast("bigint")


def shard(
    docs: DataFrame,
    shards: int,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """``id, size, text_crc32, law, shard, slot, grown_shard`` for every row; shards and slots count from 0."""
    text = F.col(text_col).cast("binary")
    sized = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("bigint").alias("text_crc32"),
    )
    rows = stored(sized.withColumn("mixed", _shuffle_key(seed)), "shard-rows")
    total = rows.count()
    buckets = max(1, -(-total // bucket_rows))
    tied = ["mixed", F.col("id").asc_nulls_first(), "text_crc32", "size"]

    # rank within the source: rows before in the same bucket, and the buckets before
    placed = rows.withColumn("bucket", _bucket(F.col("mixed") / F.lit(float(_HASH_SPAN)), buckets))
    counted = placed.groupBy("source", "bucket").agg(F.count("*").alias("n"))
    by_source = Window.partitionBy("source")
    offsets = stored(
        counted.select(
            F.col("source").alias("o_source"),
            F.col("bucket").alias("o_bucket"),
            (F.sum("n").over(by_source.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"),
            F.sum("n").over(by_source).alias("of_source"),
        ),
        "shard-offsets",
    )
    inner = placed.withColumn("nth", F.row_number().over(Window.partitionBy("source", "bucket").orderBy(*tied)))
    ranked = inner.join(
        offsets, F.col("source").eqNullSafe(F.col("o_source")) & (F.col("bucket") == F.col("o_bucket"))
    ).withColumn("fraction", (2 * (F.col("before") + F.col("nth")) - 1).cast("double") / (2 * F.col("of_source")).cast("double"))
    ranked = stored(
        ranked.select("id", "source", "size", "text_crc32", "mixed", "fraction",
                      _bucket(F.col("fraction"), buckets).alias("stretch")),
        "shard-ranked",
    )

    # position in the whole order, the same way; one row per stretch
    stretches = ranked.groupBy("stretch").agg(F.count("*").alias("n"))
    starts = stored(
        stretches.select(
            F.col("stretch").alias("s_stretch"),
            (F.sum("n").over(Window.orderBy("stretch").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("start"),
        ),
        "shard-starts",
    )
    order = Window.partitionBy("stretch").orderBy("fraction", F.col("source").asc_nulls_first(), *tied)
    position = (F.col("start") + F.col("nth") - 1).cast("bigint")
    cut = ranked.withColumn("nth", F.row_number().over(order)).join(starts, F.col("stretch") == F.col("s_stretch"))
    size, wide = total // shards, total % shards
    early = position < wide * (size + 1)
    own = F.when(early, F.floor(position / (size + 1))).otherwise(F.floor((position - wide * (size + 1)) / max(size, 1)) + wide)
    begin = F.when(early, F.col("shard") * (size + 1)).otherwise(wide * (size + 1) + (F.col("shard") - wide) * size)
    return (
        cut.withColumn("shard", own.cast("int"))
        .withColumn("slot", (position - begin).cast("bigint"))
        .select(
            F.col("id").alias(id_col), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
