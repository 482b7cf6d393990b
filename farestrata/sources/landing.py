"""The landing folder: monthly trip files and the zone lookup, kept as they arrived and never rewritten."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farestrata import schemas
from farestrata.config import LINEAGE_COLUMNS, TRIP_FILE_PREFIX, TRIPS_FOLDER, ZONES_FILE, ZONES_FOLDER
from farestrata.functions import base_name
from farestrata.operators.bronze import align_columns

TRIP_TYPES = [(f.name, f.dataType.simpleString()) for f in schemas.RAW_TRIPS if f.name not in LINEAGE_COLUMNS]


def trips_path(landing: str, file_name: str) -> str:
    return f"{landing}/{TRIPS_FOLDER}/{file_name}"


def inventory(spark: SparkSession, landing: str) -> DataFrame:
    """Published trip files with size and fingerprint; lists the folder, opens no file."""
    return _listed(spark, f"{landing}/{TRIPS_FOLDER}", f"{TRIP_FILE_PREFIX}*.parquet")


def zones_path(landing: str) -> str:
    return f"{landing}/{ZONES_FOLDER}/{ZONES_FILE}"


def zones_inventory(spark: SparkSession, landing: str) -> DataFrame:
    """The published zone lookup in the same form."""
    return _listed(spark, f"{landing}/{ZONES_FOLDER}", ZONES_FILE)


def _listed(spark: SparkSession, folder: str, names: str) -> DataFrame:
    listed = spark.read.format("binaryFile").option("pathGlobFilter", names).load(folder).drop("content")
    modified = F.unix_micros("modificationTime").cast("string")
    return listed.select(
        base_name("path").alias("source_file"),
        F.md5(F.concat_ws("-", F.col("length").cast("string"), modified)).alias("etag"),
        F.col("length").alias("content_length"),
        modified.alias("source_last_modified"),
    )


def open_trips(spark: SparkSession, landing: str, *file_names: str) -> DataFrame:
    """Files that have the same columns, as one frame."""
    return spark.read.parquet(*[trips_path(landing, name) for name in file_names])


def columns_of(spark: SparkSession, landing: str, file_name: str) -> tuple[tuple[str, str], ...]:
    """Names and types of a file's columns; reads its footer alone."""
    return tuple(spark.read.parquet(trips_path(landing, file_name)).dtypes)


def scan_all(spark: SparkSession, landing: str, loaded_at: datetime) -> DataFrame:
    """Raw rows of all landed files, whatever the spelling and order of their columns; files with the same columns are one scan."""
    # one row per file
    names = [row.source_file for row in inventory(spark, landing).collect()]
    groups: dict[tuple, list[str]] = {}
    for name in names:
        groups.setdefault(columns_of(spark, landing, name), []).append(name)
    return reduce(DataFrame.union, [scan_trips(open_trips(spark, landing, *same), loaded_at) for same in groups.values()])


def rows_per_file(landed: DataFrame) -> dict[str, int]:
    """Rows of each file of :func:`open_trips`; no column is read."""
    counted = landed.groupBy(F.col("_metadata.file_name").alias("name")).agg(F.count("*").alias("n"))
    return {row["name"]: row["n"] for row in counted.collect()}


def scan_trips(landed: DataFrame, loaded_at: datetime) -> DataFrame:
    """Raw rows of landed files: declared columns by name, plus file, row number, file time and load time."""
    meta = F.col("_metadata")
    lineage = (
        F.concat(F.lit(f"{TRIPS_FOLDER}/"), meta["file_name"]).alias("_source_file"),
        (meta["row_index"] + 1).alias("_file_row_number"),
        F.to_timestamp_ntz(F.date_format(meta["file_modification_time"], "yyyy-MM-dd HH:mm:ss"))
        .alias("_file_last_modified"),
        F.lit(loaded_at).cast("timestamp").alias("_loaded_at"),
    )
    return align_columns(landed, TRIP_TYPES, keep=lineage)


def scan_zones(spark: SparkSession, landing: str, loaded_at: datetime) -> DataFrame:
    """Zone lookup by column position, header skipped, fields optionally quoted."""
    rows = (
        spark.read.schema(schemas.ZONE_FILE)
        .options(header=True, quote='"', enforceSchema=True, mode="FAILFAST")
        .csv(zones_path(landing))
    )
    return rows.select(
        *schemas.ZONE_FILE.names,
        F.lit(f"{ZONES_FOLDER}/{ZONES_FILE}").alias("_source_file"),
        F.lit(loaded_at).cast("timestamp").alias("_loaded_at"),
    )
