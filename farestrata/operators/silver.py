"""Silver: typing, code standardisation, quality rules, quarantine and the monthly summary."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farestrata.config import (
    AIRPORT_ZONES,
    MONEY_COLUMNS,
    REQUIRED_MONEY,
    UNKNOWN_PAYMENT_TYPE,
    UNKNOWN_RATE_CODE,
    UNKNOWN_VENDOR,
    UNKNOWN_ZONE,
    Limits,
)
from farestrata.functions import blank_to_null, minutes_between, money, month_start, tag_list, whole
from farestrata.operators.dedup import mark_later_copies
from farestrata.refs import References

LINEAGE = ["_source_file", "_source_period", "_file_row_number", "_loaded_at"]
MONEY = list(MONEY_COLUMNS.values())


# --- typing -----------------------------------------------------------------------------------------------


def typed(bronze: DataFrame) -> DataFrame:
    """Business names, whole-number codes, exact decimals.

    A code that needs more than 32 bits is in no code table: it becomes NULL, and so the unknown member with its tag.
    """
    kinds = dict(bronze.dtypes)

    def code(name: str) -> Column:
        return whole(name) if kinds[name] in ("double", "float") else F.col(name).try_cast("int")

    return bronze.select(
        F.col("_record_id").alias("trip_id"),
        code("vendorid").alias("vendor_id_reported"),
        F.col("tpep_pickup_datetime").cast("timestamp_ntz").alias("pickup_datetime"),
        F.col("tpep_dropoff_datetime").cast("timestamp_ntz").alias("dropoff_datetime"),
        code("passenger_count").alias("passenger_count_reported"),
        money("trip_distance").alias("trip_distance_miles"),
        code("ratecodeid").alias("rate_code_id_reported"),
        F.upper(F.trim("store_and_fwd_flag")).alias("store_and_fwd_flag_reported"),
        code("pulocationid").alias("pickup_location_id_reported"),
        code("dolocationid").alias("dropoff_location_id_reported"),
        code("payment_type").alias("payment_type_id_reported"),
        *[money(source).alias(f"{target}_reported") for source, target in MONEY_COLUMNS.items()],
        *LINEAGE,
    )


# --- zones ------------------------------------------------------------------------------------------------

# Spellings of "no value" in the lookup, and the zone outside the city.
NO_VALUE = "N/A"
UNKNOWN = "Unknown"
OUTSIDE = "Outside of NYC"


def clean_zones(bronze: DataFrame) -> DataFrame:
    lineage = [c for c in ("_source_file", "_loaded_at") if c in bronze.columns]
    zone = blank_to_null("zone", NO_VALUE)
    borough = blank_to_null("borough", NO_VALUE, UNKNOWN)
    refill = F.when(zone == OUTSIDE, OUTSIDE).otherwise(UNKNOWN)
    return bronze.select(
        whole("locationid").alias("location_id"),
        F.coalesce(borough, refill).alias("borough"),
        F.coalesce(zone, F.lit(UNKNOWN)).alias("zone_name"),
        F.coalesce(blank_to_null("service_zone", NO_VALUE), refill).alias("service_zone"),
        F.col("locationid").isin(*AIRPORT_ZONES).alias("is_airport"),
        borough.isNull().alias("is_unknown_location"),
        *lineage,
    )


# --- code standardisation ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class Code:
    """A reported code that must exist in a reference table, else it becomes the unknown member."""

    column: str
    table: str
    key: str
    unknown: int
    tag: str

    @property
    def reported(self) -> str:
        return f"{self.column}_reported"

    @property
    def known(self) -> str:
        return f"_known_{self.column}"


# Reported codes, their unknown members and tags.
CODES = (
    Code("vendor_id", "vendors", "vendor_id", UNKNOWN_VENDOR, "VENDOR"),
    Code("rate_code_id", "rate_codes", "rate_code_id", UNKNOWN_RATE_CODE, "RATE_CODE"),
    Code("pickup_location_id", "zones", "location_id", UNKNOWN_ZONE, "PICKUP_LOCATION"),
    Code("dropoff_location_id", "zones", "location_id", UNKNOWN_ZONE, "DROPOFF_LOCATION"),
    Code("payment_type_id", "payment_types", "payment_type_id", UNKNOWN_PAYMENT_TYPE, "PAYMENT_TYPE"),
)


def known_codes(typed_trips: DataFrame, refs: References) -> DataFrame:
    """Left-join every code to its table; ``_known_*`` is NULL where the code is missing or not listed.

    No join is hinted: the code tables are small, so Spark broadcasts them by their own measured size, and a
    table that outgrows that limit is joined by shuffle.
    """
    joined = typed_trips
    for code in CODES:
        keys = getattr(refs, code.table).select(F.col(code.key).alias(code.known))
        if code.column == "vendor_id":
            # a reported unknown vendor counts as imputed; the other unknown members are listed codes
            keys = keys.where(F.col(code.known) != UNKNOWN_VENDOR)
        joined = joined.join(keys, joined[code.reported] == keys[code.known], "left")
    return joined


def imputations(limits: Limits) -> Column:
    """Which fields were imputed. Expects the output of :func:`known_codes`."""
    missing = {code.tag: F.col(code.known).isNull() for code in CODES}
    flag = F.col("store_and_fwd_flag_reported")
    passengers = F.coalesce("passenger_count_reported", F.lit(0))
    return tag_list([
        ("VENDOR", missing["VENDOR"]),
        ("PASSENGER_COUNT", ~passengers.between(1, limits.max_passengers)),
        ("RATE_CODE", missing["RATE_CODE"]),
        ("PICKUP_LOCATION", missing["PICKUP_LOCATION"]),
        ("DROPOFF_LOCATION", missing["DROPOFF_LOCATION"]),
        ("PAYMENT_TYPE", missing["PAYMENT_TYPE"]),
        ("STORE_AND_FWD_FLAG", ~(flag.eqNullSafe("Y") | flag.eqNullSafe("N"))),
    ])


def standardize(typed_trips: DataFrame, refs: References, limits: Limits = Limits()) -> DataFrame:
    def amount(name: str) -> Column:
        reported = F.col(f"{name}_reported")
        if name in REQUIRED_MONEY:
            return reported.alias(name)
        return F.coalesce(reported, F.lit(0).cast("decimal(18,2)")).alias(name)

    code = {c.column: F.coalesce(c.known, F.lit(c.unknown)).alias(c.column) for c in CODES}
    flag, passengers = F.col("store_and_fwd_flag_reported"), F.col("passenger_count_reported")
    return known_codes(typed_trips, refs).select(
        "trip_id",
        code["vendor_id"],
        "pickup_datetime",
        "dropoff_datetime",
        F.when(passengers.between(1, limits.max_passengers), passengers).alias("passenger_count"),
        "trip_distance_miles",
        minutes_between("pickup_datetime", "dropoff_datetime").alias("trip_duration_minutes"),
        code["rate_code_id"],
        F.when(flag == "Y", True).when(flag == "N", False).alias("is_store_and_forward"),
        code["pickup_location_id"],
        code["dropoff_location_id"],
        code["payment_type_id"],
        *[amount(name) for name in MONEY],
        "vendor_id_reported",
        "passenger_count_reported",
        "rate_code_id_reported",
        "store_and_fwd_flag_reported",
        "pickup_location_id_reported",
        "dropoff_location_id_reported",
        "payment_type_id_reported",
        imputations(limits).alias("dq_imputations"),
        *LINEAGE,
    )


# --- quality rules ----------------------------------------------------------------------------------------

# Two records are the same trip when these agree; the copy with the smallest row number is kept.
BUSINESS_KEY = [
    "vendor_id",
    "pickup_datetime",
    "dropoff_datetime",
    "pickup_location_id",
    "dropoff_location_id",
    "trip_distance_miles",
    "fare_amount",
    "total_amount",
]
COPY_KEY = ["_source_file", *BUSINESS_KEY]


@dataclass(frozen=True)
class Rule:
    """A rejection rule; the duplicate rule has no test of its own, its flag comes from :func:`mark_duplicates`."""

    reason: str
    broken: Callable[[Limits], Column] | None

    @property
    def flag(self) -> str:
        return f"dq_{self.reason.lower()}"

    def test(self, limits: Limits) -> Column:
        return F.coalesce(self.broken(limits), F.lit(False))


def _any(conditions: list[Column]) -> Column:
    return reduce(Column.__or__, conditions)


def _distance() -> Column:
    return F.col("trip_distance_miles")


# Fixed values, in order of priority: the first broken rule names the rejection.
RULES = (
    Rule("MISSING_DATETIME", lambda _: F.col("pickup_datetime").isNull() | F.col("dropoff_datetime").isNull()),
    Rule("DUPLICATE", None),
    Rule("OUT_OF_PERIOD", lambda _: month_start("pickup_datetime") != F.col("_source_period")),
    Rule("NON_POSITIVE_DURATION", lambda _: F.col("dropoff_datetime") <= F.col("pickup_datetime")),
    Rule("EXCESSIVE_DURATION", lambda li: F.col("trip_duration_minutes") > li.max_trip_hours * 60),
    Rule("MISSING_AMOUNT", lambda _: _any([F.col(m).isNull() for m in REQUIRED_MONEY])),
    Rule("NEGATIVE_AMOUNT", lambda _: _any([F.col(m) < 0 for m in MONEY])),
    Rule("EXCESSIVE_AMOUNT", lambda li: F.col("total_amount") > li.max_total_amount),
    Rule("INVALID_DISTANCE", lambda li: (_distance() < 0) | (_distance() > li.max_trip_miles)),
    Rule("EMPTY_TRIP", lambda _: (_distance() == 0) & (F.col("total_amount") == 0)),
)
DUPLICATE_FLAG = "dq_duplicate"
REASONS = [rule.reason for rule in RULES]
FLAGS = [rule.flag for rule in RULES]
VALUE_RULES = [rule for rule in RULES if rule.broken is not None]


def mark_duplicates(
    standardized: DataFrame, keep: Callable[[DataFrame], DataFrame] | None = None, gather: str | None = None
) -> DataFrame:
    return mark_later_copies(standardized, COPY_KEY, "_file_row_number", DUPLICATE_FLAG, keep, gather)


def evaluate(marked: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Flags, first reason, all issues and validity of records whose duplicates are already marked."""
    flagged = marked.withColumns({rule.flag: rule.test(limits) for rule in VALUE_RULES})
    return flagged.withColumns({
        "rejection_reason": F.coalesce(*[F.when(F.col(r.flag), F.lit(r.reason)) for r in RULES]),
        "dq_issues": tag_list([(r.reason, F.col(r.flag)) for r in RULES]),
    }).withColumn("is_valid", F.col("rejection_reason").isNull())


# Output columns.
EVALUATED_COLUMNS = [
    "trip_id",
    "vendor_id",
    "pickup_datetime",
    "dropoff_datetime",
    "passenger_count",
    "trip_distance_miles",
    "trip_duration_minutes",
    "rate_code_id",
    "is_store_and_forward",
    "pickup_location_id",
    "dropoff_location_id",
    "payment_type_id",
    *MONEY,
    "vendor_id_reported",
    "passenger_count_reported",
    "rate_code_id_reported",
    "store_and_fwd_flag_reported",
    "pickup_location_id_reported",
    "dropoff_location_id_reported",
    "payment_type_id_reported",
    *FLAGS,
    "rejection_reason",
    "dq_issues",
    "dq_imputations",
    "is_valid",
    *LINEAGE,
]


def standardized_trips(
    bronze: DataFrame,
    refs: References,
    limits: Limits = Limits(),
    keep: Callable[[DataFrame], DataFrame] | None = None,
    gather: str | None = None,
) -> DataFrame:
    """Every bronze record, typed, standardised and judged; ``keep`` and ``gather`` as in :func:`mark_later_copies`."""
    marked = mark_duplicates(standardize(typed(bronze), refs, limits), keep, gather)
    return evaluate(marked, limits).select(*EVALUATED_COLUMNS)


# Output columns.
VALID_COLUMNS = [
    "trip_id",
    "vendor_id",
    "pickup_datetime",
    "dropoff_datetime",
    "passenger_count",
    "trip_distance_miles",
    "trip_duration_minutes",
    "rate_code_id",
    "is_store_and_forward",
    "pickup_location_id",
    "dropoff_location_id",
    "payment_type_id",
    *MONEY,
    "dq_imputations",
    "_source_file",
    "_source_period",
    "_loaded_at",
]


def valid_trips(evaluated: DataFrame) -> DataFrame:
    return evaluated.where("is_valid").select(*VALID_COLUMNS)


# Output columns.
REJECTED_COLUMNS = [
    "trip_id",
    "rejection_reason",
    "dq_issues",
    "pickup_datetime",
    "dropoff_datetime",
    "trip_duration_minutes",
    "trip_distance_miles",
    "passenger_count_reported",
    "pickup_location_id_reported",
    "dropoff_location_id_reported",
    "payment_type_id_reported",
    "fare_amount",
    "total_amount",
    "_source_file",
    "_source_period",
    "_file_row_number",
]


def rejected_trips(evaluated: DataFrame) -> DataFrame:
    return evaluated.where(~F.col("is_valid")).select(*REJECTED_COLUMNS)


def quality_summary(evaluated: DataFrame) -> DataFrame:
    """Per source month: records received, valid, rejected by reason, imputed."""
    total, valid = F.count("*"), F.count_if("is_valid")
    return evaluated.groupBy(F.col("_source_period").alias("source_period")).agg(
        total.alias("total_records"),
        valid.alias("valid_records"),
        F.count_if(~F.col("is_valid")).alias("rejected_records"),
        F.round(F.lit(100).cast("decimal(4,1)") * valid / total, 2).alias("pct_valid"),
        *[F.count_if(F.col("rejection_reason") == r).alias(f"rejected_{r.lower()}") for r in REASONS],
        F.count_if(F.col("dq_imputations").isNotNull()).alias("records_with_imputations"),
        F.count_if(F.col("passenger_count").isNull()).alias("passenger_count_unknown"),
    )
