"""Column functions; every one of them stays inside Catalyst expressions."""

from farestrata.functions.keys import date_key, surrogate_key
from farestrata.functions.numbers import money, ratio_percent, whole
from farestrata.functions.temporal import (
    day_name_es,
    iso_day_of_week,
    minutes_between,
    month_name_es,
    month_start,
    period_date,
    seconds_between,
)
from farestrata.functions.text import base_name, blank_to_null, period_of_file, tag_list

__all__ = [
    "base_name",
    "blank_to_null",
    "date_key",
    "day_name_es",
    "iso_day_of_week",
    "minutes_between",
    "money",
    "month_name_es",
    "month_start",
    "period_date",
    "period_of_file",
    "ratio_percent",
    "seconds_between",
    "surrogate_key",
    "tag_list",
    "whole",
]
