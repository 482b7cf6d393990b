"""Keys of facts and dimensions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that stands for NULL inside a hashed key, and the separator.
NULL_MARK = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def surrogate_key(*columns: Column | str) -> Column:
    """Hash of the natural key, equal in facts and dimensions, so facts need no lookup join."""
    columns = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.md5(F.concat_ws(SEPARATOR, *[F.coalesce(c.cast("string"), F.lit(NULL_MARK)) for c in columns]))


def date_key(moment: Column | str) -> Column:
    """Integer yyyymmdd."""
    return (F.year(moment) * 10000 + F.month(moment) * 100 + F.dayofmonth(moment)).cast("int")
