"""Wall-clock arithmetic. All inputs are zone-free timestamps or dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from farestrata.functions.numbers import AMOUNT

# Spanish names in calendar order.
MONTHS_ES = (
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
)
DAYS_ES = ("Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo")


# Any moment before all data: seconds counted from it are never negative, so cutting equals flooring.
_ORIGIN = "timestamp_ntz'0001-01-01 00:00:00'"


def _seconds(moment: Column) -> Column:
    elapsed = moment.cast("timestamp_ntz") - F.expr(_ORIGIN)
    return elapsed.cast("interval second").cast("bigint")


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Number of second boundaries from start to end.

    Both are measured on the wall clock, so the session time zone and its clock changes have no part in it.
    """
    start = F.col(start) if isinstance(start, str) else start
    end = F.col(end) if isinstance(end, str) else end
    return _seconds(end) - _seconds(start)


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Minutes with two decimals. Whole seconds never fall half-way between two of them, so doubles are exact here."""
    return (seconds_between(start, end) / F.lit(60.0)).cast(AMOUNT)


def month_start(moment: Column | str) -> Column:
    return F.trunc(F.to_date(moment), "MM")


def period_date(period: Column | str) -> Column:
    """First day of a month written yyyy-MM."""
    return F.to_date(F.concat(period, F.lit("-01")))


def iso_day_of_week(day: Column | str) -> Column:
    """1 is Monday, 7 is Sunday."""
    return F.weekday(day) + 1


def _name(names: tuple[str, ...], number: Column) -> Column:
    return F.get(F.array(*[F.lit(n) for n in names]), number - 1)


def month_name_es(month: Column) -> Column:
    return _name(MONTHS_ES, month)


def day_name_es(iso_day: Column) -> Column:
    return _name(DAYS_ES, iso_day)
