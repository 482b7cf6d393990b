"""Exact numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: type of money, miles and minutes.
AMOUNT = "decimal(18,2)"


def whole(column: Column | str) -> Column:
    """Integer code; the source may carry it as 1.0, and a cast alone would truncate. NULL if it needs more than 32 bits."""
    return F.round(column, 0).try_cast("int")


def money(column: Column | str) -> Column:
    """Two exact decimals; the cast itself rounds half up."""
    return (F.col(column) if isinstance(column, str) else column).cast(AMOUNT)


def ratio_percent(part: Column, total: Column) -> Column:
    """100 * part / total with two decimals; NULL when the total is zero."""
    return F.round(F.lit(100) * part / F.nullif(total, F.lit(0)), 2)
