"""Stored tables whose rows are replaced file by file.

Every load writes new partitions and touches none that readers use. What readers see is decided by a small list of
current loads, one row per source file; appending to that list is the commit. A load that fails before it leaves
the table as it was, and a file whose rows are all gone simply points to an empty load.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from contextlib import AbstractContextManager, nullcontext
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farestrata.functions import base_name
from farestrata.session import held, tidy
from farestrata.sources.files import Files

LOADS = T.StructType([
    T.StructField("source_file", T.StringType(), False),
    T.StructField("load_id", T.StringType(), False),
    T.StructField("built_from", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("fields", T.StringType()),
    T.StructField("committed_at", T.TimestampType()),
    T.StructField("note", T.StringType()),
])
#: How long superseded rows stay readable for what began to read them before.
KEEP = timedelta(days=7)
WHOLE = "*"
WHOLE_PART = "whole"


@dataclass(frozen=True)
class Load:
    source_file: str
    load_id: str
    built_from: str | None
    rows: int
    fields: str
    committed_at: datetime
    note: str | None = None


def new_run() -> str:
    return f"r{datetime.now(UTC):%Y%m%dT%H%M%S%f}{uuid.uuid4().hex[:6]}"


def _began_before(run: str, moment: datetime) -> bool:
    """By the time in the name of :func:`new_run`; other folders are not ours."""
    try:
        return datetime.strptime(run[1:22], "%Y%m%dT%H%M%S%f").replace(tzinfo=UTC) <= moment
    except ValueError:
        return False


#: Files that a task may hold open before it sorts its rows instead.
WRITERS = 1_000


def _as_they_come(spark: SparkSession) -> AbstractContextManager[None]:
    """Tasks write all their files side by side, as wide rows sorted by file would be spilled. A setting of the user stays."""
    return held(spark, "spark.sql.maxConcurrentOutputFileWriters", WRITERS, "0")


class FileTable:
    """A Parquet table under ``root``; ``whole`` tables are replaced in one piece.

    Each run writes folders of its own, so runs may work side by side.
    """

    def __init__(self, spark: SparkSession, root: str, whole: bool = False):
        self.spark = spark
        self.data = f"{root}/data"
        self.loads = f"{root}/loads"
        self.whole = whole

    def current(self) -> dict[str, Load]:
        """The load in use per source file. One row per file, so it fits the driver at any data size."""
        try:
            listed = self.spark.read.schema(LOADS).option("recursiveFileLookup", True).parquet(self.loads)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}
        newest = listed.groupBy("source_file").agg(F.max_by(F.struct(*LOADS.names), "committed_at").alias("load"))
        return {row.source_file: Load(**row.asDict()) for row in newest.select("load.*").collect()}

    def stage(self, df: DataFrame, run: str, gathered: bool = False) -> None:
        """Write the rows next to the ones in use; nothing reads them yet.

        ``gathered`` rows come from stored files without a shuffle, so a task has rows of few files and writes them as they are.
        """
        stem = F.lit(WHOLE_PART) if self.whole else F.replace(base_name("_source_file"), F.lit(".parquet"), F.lit(""))
        rows = df.withColumn("_part", stem)
        with tidy(self.spark), _as_they_come(self.spark) if gathered else nullcontext():
            # else rows are gathered by file in pieces of bounded size, so a file's folder doesn't get one file per task
            placed = rows if gathered else rows.hint("rebalance", "_part")
            placed.write.option("compression", "zstd").partitionBy("_part").parquet(f"{self.data}/{run}")

    def staged_rows(self, run: str, files: Iterable[str], schema: T.StructType) -> dict[str, int]:
        with_part = T.StructType([*schema.fields, T.StructField("_part", T.StringType())])
        written = self.spark.read.schema(with_part).parquet(f"{self.data}/{run}")
        counted = {row["_part"]: row["count"] for row in written.groupBy("_part").count().collect()}
        return {f: counted.get(_part(f), 0) for f in files}

    def staged_files(self, run: str, schema: T.StructType) -> dict[str, int]:
        """Rows per source file that the run wrote."""
        written = self.spark.read.schema(schema).parquet(f"{self.data}/{run}")
        return {row["_source_file"]: row["count"] for row in written.groupBy("_source_file").count().collect()}

    def commit(
        self,
        run: str,
        rows: dict[str, int],
        schema: T.StructType,
        built_from: dict[str, str] | None = None,
        notes: dict[str, str] | None = None,
    ) -> None:
        """Make the rows of a run the current ones; a file's note becomes current with them."""
        now = datetime.now(UTC)
        entries = [(f, f"{run}/_part={_part(f)}", (built_from or {}).get(f), n, schema.json(), now, (notes or {}).get(f))
                   for f, n in rows.items()]
        self.spark.createDataFrame(entries, LOADS).coalesce(1).write.parquet(f"{self.loads}/{run}")

    def compact(self, keep: timedelta = KEEP) -> int:
        """Shorten the list of loads and remove the rows that nothing uses any more; returns the number of folders removed.

        What goes was superseded more than ``keep`` ago, or belongs to a run that began as long ago and never became current. So ``keep``
        must be longer than any load, and than any query on rows read before. The list itself is replaced at once: a query that is
        just being built may have to be built again. If this ends half-way, the next call does the rest.
        """
        files, until = Files(self.spark, self.data), datetime.now(UTC) - keep
        lists = [f"{self.loads}/{name}" for name in files.names_in(self.loads)]
        if not lists:
            return 0
        # a call that ended between writing and removing leaves some loads in two lists
        listed = self.spark.read.schema(LOADS).option("recursiveFileLookup", True).parquet(*lists).distinct()
        following = F.lead("committed_at").over(Window.partitionBy("source_file").orderBy("committed_at"))
        used = (
            listed.withColumn("replaced_at", following)
            .where(F.col("replaced_at").isNull() | (F.col("replaced_at") > F.lit(until)))
            .drop("replaced_at")
        )
        # one row per file, and per load of the last days
        folders = {row.load_id for row in used.select("load_id").collect()}
        if len(lists) > 1 or listed.count() > len(folders):
            used.coalesce(1).write.parquet(f"{self.loads}/{new_run()}")
            for old in lists:
                files.remove_one(old)
        removed = 0
        for run in files.names_in(self.data):
            if not _began_before(run, until):
                continue
            parts = [name for name in files.names_in(f"{self.data}/{run}") if name.startswith("_part=")]
            unused = [name for name in parts if f"{run}/{unquote(name)}" not in folders]
            if len(unused) == len(parts):
                files.remove_one(f"{self.data}/{run}")
            else:
                for name in unused:
                    files.remove_one(f"{self.data}/{run}/{name}")
            removed += len(unused)
        return removed

    def replace(
        self,
        df: DataFrame,
        files: Iterable[str] | None = None,
        built_from: dict[str, str] | None = None,
        gathered: bool = False,
    ) -> dict[str, int]:
        """Replace the rows of ``files`` by ``df``; a file without rows in ``df`` becomes empty.

        Without ``files`` it is the files that ``df`` has rows of, or the whole table. ``gathered`` as in :meth:`stage`.
        """
        run = new_run()
        self.stage(df, run, gathered)
        if files is None and not self.whole:
            rows = self.staged_files(run, df.schema)
        else:
            rows = self.staged_rows(run, files or (WHOLE,), df.schema)
        self.commit(run, rows, df.schema, built_from)
        return rows

    def read(self, files: Iterable[str] | None = None) -> DataFrame:
        """Rows in use. Columns that only newer loads have are NULL in the older ones.

        A column whose type differs between loads is read in the wider type; types that Parquet can't widen are refused.
        """
        current = self.current()
        if not current:
            raise LookupError(f"{self.data} has not been loaded yet")
        chosen = [current[f] for f in (current if files is None else files) if f in current]
        schema = _merged(load.fields for load in sorted(current.values(), key=lambda load: load.committed_at))
        folders = [f"{self.data}/{load.load_id}" for load in chosen if load.rows]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)


def _part(source_file: str) -> str:
    return WHOLE_PART if source_file == WHOLE else source_file.rsplit("/", 1)[-1].replace(".parquet", "")


#: Types, narrow first, in whose order Spark reads a column of one type as any later one.
WIDENINGS = (
    (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()),
    (T.ByteType(), T.ShortType(), T.IntegerType(), T.DoubleType()),
    (T.FloatType(), T.DoubleType()),
    (T.DateType(), T.TimestampNTZType()),
)


def _wider(name: str, a: T.DataType, b: T.DataType) -> T.DataType:
    if a == b:
        return a
    for order in WIDENINGS:
        if a in order and b in order:
            return max(a, b, key=order.index)
    raise TypeError(f"column {name} is stored as {a.simpleString()} and as {b.simpleString()}; rebuild the table")


def _merged(schemas: Iterable[str]) -> T.StructType:
    """Columns of all ``schemas`` in the order in which loads brought them."""
    fields: dict[str, T.DataType] = {}
    for text in dict.fromkeys(schemas):
        for field in T.StructType.fromJson(json.loads(text)).fields:
            fields[field.name] = _wider(field.name, fields.get(field.name, field.dataType), field.dataType)
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])
