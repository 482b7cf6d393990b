"""Exact duplicates by a persistent index of digests.

The index is a Parquet table in a folder, bucketed and sorted by SHA-256 digest, with one row per known text and the
id that stands for it. A batch is reduced to one row per digest first (so a text of which there are very many copies
crosses the network once per task), joined with the index by an anti-join that needs no shuffle of the index, and what is new is
appended. Only DataFrame operations are used.

NULL texts count as empty. Of equal texts in one batch the largest id stays; a text the index knows from an earlier
batch stays with the id of then, and other ids in the batch are dropped; entering a batch again, after a failure, gives the same answer. NULL ids lose against others; if a group has NULL ids alone,
they stand for it. Of rows that repeat both id and text one is marked as kept, also where all ids are NULL; which of them is not said. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farestrata.llm.common import drop_losers, stored


def digest(text_col: str):
    return F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256)


LAYOUT = "buckets int, id_type string"


class DigestIndex:
    """The index in ``folder``, opened under a name of its own in the session.

    The number of buckets and the type of ids are kept with the index, so a later session with other settings opens it as it
    was made; asking for others is refused.
    """

    def __init__(self, spark: SparkSession, folder: str, id_type: str | None = None, buckets: int | None = None):
        self.spark = spark
        made = self._layout(folder)
        if made is None:
            made = (buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), id_type or "bigint")
            layout = F.lit(made[0]).alias("buckets"), F.lit(made[1]).alias("id_type")
            spark.range(1, numPartitions=1).select(*layout).write.json(f"{folder}/layout")
        elif (buckets or made[0], id_type or made[1]) != made:
            raise ValueError(f"the index has {made[0]} buckets and ids of type {made[1]}")
        self.buckets, kept_type = made
        self.name = f"digest_index_{uuid.uuid4().hex}"
        place = f"{folder}/data".replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {self.name} (text_sha256 STRING, keep_id {kept_type}) USING parquet "
            f"CLUSTERED BY (text_sha256) SORTED BY (text_sha256) INTO {self.buckets} BUCKETS LOCATION '{place}'"
        )

    def _layout(self, folder: str) -> tuple[int, str] | None:
        try:
            found = self.spark.read.schema(LAYOUT).json(f"{folder}/layout").first()
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return tuple(found) if found else None

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, new: DataFrame) -> None:
        """``new`` has ``text_sha256, keep_id`` and no digest that the index knows."""
        (
            new.select("text_sha256", "keep_id").repartition(self.buckets, "text_sha256").write.mode("append")
            .format("parquet").bucketBy(self.buckets, "text_sha256").sortBy("text_sha256").saveAsTable(self.name)
        )

    def close(self) -> None:
        """Forget the name; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def judge(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Enter a batch into the index: ``id, keep_id, group_size, kept, text_sha256`` for every row.

    ``group_size`` counts the rows of the batch with that text.
    """
    number = F.monotonically_increasing_id().alias("_row")  # stored, so it stays with its row
    digests = stored(docs.select(F.col(id_col), digest(text_col).alias("text_sha256"), number), "digests")
    entries = stored(
        digests.groupBy("text_sha256", F.col(id_col).alias("entry_id")).agg(F.count("*").alias("n"), F.min("_row").alias("first_row")),
        "digest-entries",
    )
    groups = stored(
        entries.groupBy("text_sha256").agg(F.max("entry_id").alias("newest_id"), F.sum("n").alias("group_size")), "digest-groups"
    )
    known = index.read().hint("merge")
    fresh = groups.join(known, "text_sha256", "left_anti")
    index.append(stored(fresh.withColumnRenamed("newest_id", "keep_id"), "digest-fresh"))
    standing = groups.join(index.read().hint("merge"), "text_sha256").select("text_sha256", "keep_id", "group_size")
    # an id that stands for the text since an earlier batch need not be in this one
    first = entries.select(F.col("text_sha256").alias("entry_digest"), "entry_id", "first_row")
    same = (F.col("text_sha256") == F.col("entry_digest")) & F.col("keep_id").eqNullSafe(F.col("entry_id"))
    verdicts = stored(standing.join(first, same, "left").drop("entry_digest", "entry_id"), "digest-verdicts")
    # both sides come from storage, so Spark can split a digest that very many rows share
    return digests.join(verdicts, "text_sha256").select(
        id_col,
        "keep_id",
        "group_size",
        F.col("_row").eqNullSafe(F.col("first_row")).alias("kept"),
        "text_sha256",
    )


def deduplicate(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text is kept elsewhere."""
    entries = stored(judge(docs, index, id_col, text_col), "digest-entries")
    standing = F.col(id_col).eqNullSafe(F.col("keep_id"))
    losers = stored(entries.where(~standing).select(id_col, "text_sha256").distinct(), "digest-losers")
    left = drop_losers(docs, losers, {id_col: F.col(id_col), "text_sha256": digest(text_col)})
    if entries.where(standing & ~F.col("kept")).isEmpty():
        return left
    hidden = f"_digest_{uuid.uuid4().hex[:8]}"
    return left.withColumn(hidden, digest(text_col)).dropDuplicates([id_col, hidden]).drop(hidden)
