"""Names, thresholds and code lists shared by every layer."""

from __future__ import annotations

from dataclasses import dataclass

# Column names published for the monthly trip files, lower-cased.
TRIP_COLUMNS = (
    "vendorid",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "ratecodeid",
    "store_and_fwd_flag",
    "pulocationid",
    "dolocationid",
    "payment_type",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
    "airport_fee",
    "cbd_congestion_fee",
)

# Lineage columns added while loading a file.
LINEAGE_COLUMNS = ("_source_file", "_file_row_number", "_file_last_modified", "_loaded_at")

# Published money column -> name in the silver and gold layers.
MONEY_COLUMNS = {
    "fare_amount": "fare_amount",
    "extra": "extra_amount",
    "mta_tax": "mta_tax_amount",
    "tip_amount": "tip_amount",
    "tolls_amount": "tolls_amount",
    "improvement_surcharge": "improvement_surcharge_amount",
    "congestion_surcharge": "congestion_surcharge_amount",
    "airport_fee": "airport_fee_amount",
    "cbd_congestion_fee": "cbd_congestion_fee_amount",
    "total_amount": "total_amount",
}

# A missing charge means "not charged"; fare and total have no such default.
REQUIRED_MONEY = ("fare_amount", "total_amount")

# Members that stand for an unknown code, and the airport zones.
UNKNOWN_VENDOR = -1
UNKNOWN_RATE_CODE = 99
UNKNOWN_PAYMENT_TYPE = 5
UNKNOWN_ZONE = 264
AIRPORT_ZONES = (1, 132, 138)
AIRPORT_RATES = (2, 3)
CARD_PAYMENT = 1

# Datasets and states of the ingestion ledger.
TRIPS_DATASET = "yellow_tripdata"
ZONES_DATASET = "taxi_zone_lookup"
LOADED = "LOADED"
SKIPPED = "SKIPPED"
NOT_AVAILABLE = "NOT_AVAILABLE"
FAILED = "FAILED"

# Naming of the landing files.
TRIPS_FOLDER = "yellow"
ZONES_FOLDER = "zones"
TRIP_FILE_PREFIX = "yellow_tripdata_"
ZONES_FILE = "taxi_zone_lookup.csv"

# Longest message kept in the ledger.
MESSAGE_LIMIT = 2000


@dataclass(frozen=True)
class Limits:
    """Thresholds of the quality rules (fixed values as defaults)."""

    max_trip_hours: int = 24
    max_trip_miles: int = 200
    max_total_amount: int = 1000
    max_passengers: int = 6


@dataclass(frozen=True)
class Calendar:
    """Day range of the date dimension; the end is exclusive (fixed values as defaults)."""

    start: str = "2024-01-01"
    end: str = "2031-01-01"
