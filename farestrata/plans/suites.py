"""Checks declared for the tables of each layer."""

from __future__ import annotations

from farestrata.operators.checks import Relationship, TableChecks
from farestrata.operators.gold import DAY_PARTS
from farestrata.operators.silver import REASONS

# Accepted service zones.
SERVICE_ZONES = ("Yellow Zone", "Boro Zone", "Airports", "EWR", "Unknown", "Outside of NYC")

# The declared checks of all layers.
RAW = (
    TableChecks("raw.trips", not_null=("_source_file", "_file_row_number", "_loaded_at")),
    TableChecks("raw.zones", not_null=("locationid",), unique=("locationid",)),
    TableChecks("raw.ledger", not_null=("source_file",), unique=("source_file",)),
)

BRONZE = (
    TableChecks(
        "bronze.trips",
        not_null=("_record_id", "_source_file", "_source_period", "_file_row_number", "_loaded_at"),
        unique=("_record_id",),
    ),
    TableChecks(
        "bronze.zones", not_null=("locationid", "_source_file", "_loaded_at"), unique=("locationid",)
    ),
)

REFERENCES = (
    TableChecks("silver.vendors", not_null=("vendor_id", "vendor_name"), unique=("vendor_id",)),
    TableChecks("silver.rate_codes", not_null=("rate_code_id",), unique=("rate_code_id",)),
    TableChecks("silver.payment_types", not_null=("payment_type_id",), unique=("payment_type_id",)),
)

SILVER = (
    TableChecks(
        "silver.zones",
        not_null=("location_id", "borough", "zone_name", "service_zone"),
        unique=("location_id",),
        accepted_values={"service_zone": SERVICE_ZONES},
    ),
    TableChecks(
        "silver.standardized",
        not_null=(
            "trip_id",
            "vendor_id",
            "rate_code_id",
            "payment_type_id",
            "pickup_location_id",
            "dropoff_location_id",
            "is_valid",
            "_source_file",
            "_source_period",
        ),
        unique=("trip_id",),
        accepted_values={"rejection_reason": REASONS},
    ),
    TableChecks(
        "silver.valid",
        not_null=(
            "trip_id",
            "vendor_id",
            "pickup_datetime",
            "dropoff_datetime",
            "trip_distance_miles",
            "rate_code_id",
            "pickup_location_id",
            "dropoff_location_id",
            "payment_type_id",
            "_source_file",
        ),
        unique=("trip_id",),
        relationships=(
            Relationship("vendor_id", "silver.vendors", "vendor_id"),
            Relationship("rate_code_id", "silver.rate_codes", "rate_code_id"),
            Relationship("pickup_location_id", "silver.zones", "location_id"),
            Relationship("dropoff_location_id", "silver.zones", "location_id"),
            Relationship("payment_type_id", "silver.payment_types", "payment_type_id"),
        ),
        accepted_range={"passenger_count": (1, 6), "trip_distance_miles": (0, 200)},
        expressions=("dropoff_datetime > pickup_datetime", "total_amount >= 0 and fare_amount >= 0"),
    ),
    TableChecks("silver.rejected", not_null=("trip_id", "rejection_reason"), unique=("trip_id",)),
    TableChecks("silver.quality_summary", not_null=("source_period",), unique=("source_period",)),
)

_FACT_KEYS = (
    ("pickup_date_key", "gold.dim_date", "date_key"),
    ("pickup_time_key", "gold.dim_time", "time_key"),
    ("dropoff_date_key", "gold.dim_date", "date_key"),
    ("dropoff_time_key", "gold.dim_time", "time_key"),
    ("pickup_zone_key", "gold.dim_zone", "zone_key"),
    ("dropoff_zone_key", "gold.dim_zone", "zone_key"),
    ("vendor_key", "gold.dim_vendor", "vendor_key"),
    ("rate_code_key", "gold.dim_rate_code", "rate_code_key"),
    ("payment_type_key", "gold.dim_payment_type", "payment_type_key"),
)


def _keyed(table: str, *keys: str, **more) -> TableChecks:
    return TableChecks(table, not_null=keys, unique=keys, **more)


GOLD = (
    TableChecks(
        "gold.fct_trips",
        not_null=("trip_key", *[column for column, _, _ in _FACT_KEYS], "_source_file"),
        unique=("trip_key",),
        relationships=tuple(Relationship(*key) for key in _FACT_KEYS),
    ),
    _keyed("gold.dim_date", "date_key", "full_date"),
    _keyed("gold.dim_time", "time_key", accepted_values={"day_part": [name for name, _, _ in DAY_PARTS]}),
    _keyed("gold.dim_zone", "zone_key", "location_id"),
    _keyed("gold.dim_vendor", "vendor_key", "vendor_id"),
    _keyed("gold.dim_rate_code", "rate_code_key", "rate_code_id"),
    _keyed("gold.dim_payment_type", "payment_type_key", "payment_type_id"),
)

LAYERS = {"raw": RAW, "bronze": BRONZE, "silver": (*REFERENCES, *SILVER), "gold": GOLD}
