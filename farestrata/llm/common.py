"""Helpers that the corpus operators share."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farestrata.session import shared_folder

#: Words are runs of characters other than space and the control characters 0x09 to 0x0D.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
WORD_SQL = r"[^\x20\x09-\x0D]+"
#: Bytes of one Arrow batch that a Python worker holds at a time.
BATCH_BYTES = "16m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession, label: str) -> str:
    """A folder of its own in the storage that driver and executors share."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here and Spark knows the size."""
    folder = new_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _bytes(size: str) -> int:
    number, unit = re.fullmatch(r"(-?\d+)\s*([kmgtp]?)i?b?", size.strip().lower()).groups()
    return int(number) * 1024 ** " kmgtp".index(unit or " ")


def keep_batches_small(spark: SparkSession) -> None:
    """Very long texts must not fill one Arrow batch. A lower limit of the user stays.

    The setting is read when the plan runs, so it can't be put back here and holds for the session.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    known = spark.conf.get(name, None)
    if known is None or not 0 < _bytes(known) <= _bytes(BATCH_BYTES):
        spark.conf.set(name, BATCH_BYTES)


def map_arrow(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch | tuple]], schema: str
) -> DataFrame:
    """Run ``function`` over record batches; it yields batches, or tuples of columns in the order of ``schema``."""
    ship(df.sparkSession)
    keep_batches_small(df.sparkSession)
    target = df.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(target)

    def column(values, kind: pa.DataType) -> pa.Array:
        if isinstance(values, pa.ChunkedArray):
            values = values.combine_chunks()
        return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in function(batches):
            if isinstance(found, tuple):
                found = pa.RecordBatch.from_arrays(
                    [column(values, field.type) for values, field in zip(found, arrow, strict=True)], schema=arrow
                )
            yield found

    return df.mapInArrow(run, target)


def map_rows(
    df: DataFrame, function: Callable[[Iterator[tuple[list, ...]]], Iterable[tuple[list, ...]]], schema: str
) -> DataFrame:
    """Run ``function`` over batches given as one Python list per column; it yields lists in the order of ``schema``."""
    ship(df.sparkSession)
    keep_batches_small(df.sparkSession)
    target = df.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def lists() -> Iterator[tuple[list, ...]]:
            for batch in batches:
                yield tuple(column.to_pylist() for column in batch.columns)

        for columns in function(lists()):
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, field.type) for values, field in zip(columns, arrow, strict=True)], schema=arrow
            )

    return df.mapInArrow(run, target)


def seeded_rank(key: str, seed: int) -> Column:
    """60 bits that depend on a seed and a key alone, as DuckDB can compute them too."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def held_out(key: str) -> Column:
    """The fold that no model learns from: CRC-32 of the key as text, remainder 0 by 5."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def drop_losers(docs: DataFrame, losers: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """``docs`` without the rows whose ``keys`` stand in ``losers``; NULL keys match NULL keys.

    Always a sort-merge join: the list grows with the documents, so the plan is the same at every size.
    """
    names = {name: f"_key_{i}_{uuid.uuid4().hex[:8]}" for i, name in enumerate(keys)}
    right = losers.hint("merge").select(*[F.col(name).alias(hidden) for name, hidden in names.items()])
    same = F.lit(True)
    for name, value in keys.items():
        same = same & value.eqNullSafe(F.col(names[name]))
    return docs.join(right, same, "left_anti")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application, where it isn't installed on all machines."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as bundle:
        for file in sorted(package.rglob("*.py")):
            bundle.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(app)
