"""Bronze: a faithful copy of the source plus lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farestrata.config import LINEAGE_COLUMNS, TRIP_COLUMNS
from farestrata.functions import period_of_file, surrogate_key


def bronze_trips(raw: DataFrame) -> DataFrame:
    extra = [c for c in raw.columns if c not in (*TRIP_COLUMNS, *LINEAGE_COLUMNS)]
    return raw.select(
        *TRIP_COLUMNS,
        surrogate_key("_source_file", "_file_row_number").alias("_record_id"),
        "_source_file",
        period_of_file("_source_file").alias("_source_period"),
        "_file_row_number",
        "_file_last_modified",
        "_loaded_at",
        *extra,
    )


def bronze_zones(raw: DataFrame) -> DataFrame:
    return raw.select("locationid", "borough", "zone", "service_zone", "_source_file", "_loaded_at")


def append_new_columns(stored: DataFrame, arriving: DataFrame) -> DataFrame:
    """Rows of both; a column only one of them has is NULL for the other."""
    return stored.unionByName(arriving, allowMissingColumns=True)


def align_columns(landed: DataFrame, wanted: list[tuple[str, str]], keep: tuple[str, ...] = ()) -> DataFrame:
    """Match columns by name ignoring case: missing ones become NULL, others are left out.

    ``wanted`` lists (name, type); fractional values are rounded, not cut, on their way to a whole type.
    """
    by_name = {c.lower(): c for c in landed.columns}
    kinds = dict(landed.dtypes)
    picked = []
    for name, kind in wanted:
        if name not in by_name:
            picked.append(F.lit(None).cast(kind).alias(name))
            continue
        source = by_name[name]
        column = F.col(f"`{source}`")
        if kind == "bigint" and kinds[source] in ("double", "float"):
            column = F.round(column, 0)
        picked.append(column.cast(kind).alias(name))
    return landed.select(*picked, *keep)


def schema_drift(columns: list[str], expected: tuple[str, ...] = TRIP_COLUMNS) -> list[tuple[str, str]]:
    """(column, state): expected columns that are missing, and columns nobody expects."""
    states = dict.fromkeys(expected, "missing")
    for column in columns:
        if states.pop(column.lower(), None) is None:
            states[column] = "unexpected"
    return list(states.items())


def schema_drift_report(landed: DataFrame, expected: tuple[str, ...] = TRIP_COLUMNS) -> DataFrame:
    """One row per expected or found column: its state and how many values it brings, in one pass."""
    states = dict(schema_drift(landed.columns, expected))
    states |= {c.lower(): "present" for c in landed.columns if c not in states}
    found = {c.lower(): c for c in landed.columns}
    filled = [
        F.struct(
            F.lit(name.lower()).alias("column_name"),
            F.lit(state).alias("state"),
            (F.count(F.col(f"`{found[name.lower()]}`")) if name.lower() in found else F.lit(0).cast("bigint"))
            .alias("filled_rows"),
        )
        for name, state in states.items()
    ]
    return landed.agg(F.array(*filled).alias("report")).select(F.inline("report"))
