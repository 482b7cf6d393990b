"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tag_list(tags: list[tuple[str, Column]]) -> Column:
    """Names of the conditions that hold, in the given order, comma-separated; NULL if none holds."""
    return F.nullif(F.concat_ws(",", *[F.when(holds, F.lit(tag)) for tag, holds in tags]), F.lit(""))


def blank_to_null(column: Column | str, *empty: str) -> Column:
    """Trimmed text; the empty string and the given spellings of "no value" become NULL."""
    text = F.trim(column)
    return F.when(~text.isin("", *empty), text)


def base_name(path: Column | str) -> Column:
    """Last segment of a path. Two paths end in the same file exactly when these are equal."""
    return F.substring_index(path, "/", -1)


def period_of_file(path: Column | str) -> Column:
    """First day of the month in a file name that ends in ``yyyy-MM.parquet``."""
    return F.to_date(F.concat(F.substring(path, -15, 7), F.lit("-01")))
