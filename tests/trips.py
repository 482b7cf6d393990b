"""Hand-made raw trips."""

from __future__ import annotations

from datetime import datetime

from farestrata import schemas

FILE = "yellow/yellow_tripdata_2025-03.parquet"
GOOD = {
    "vendorid": 1,
    "tpep_pickup_datetime": datetime(2025, 3, 10, 8, 0, 0),
    "tpep_dropoff_datetime": datetime(2025, 3, 10, 8, 30, 0),
    "passenger_count": 1,
    "trip_distance": 5.0,
    "ratecodeid": 1,
    "store_and_fwd_flag": "N",
    "pulocationid": 1,
    "dolocationid": 2,
    "payment_type": 1,
    "fare_amount": 20.0,
    "extra": 1.0,
    "mta_tax": 0.5,
    "tip_amount": 3.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 1.0,
    "total_amount": 25.5,
    "congestion_surcharge": 2.5,
    "airport_fee": None,
    "cbd_congestion_fee": 0.75,
    "_source_file": FILE,
    "_file_last_modified": datetime(2025, 4, 20),
    "_loaded_at": datetime(2025, 4, 21),
}


def raw(spark, *changes: dict, schema=schemas.RAW_TRIPS):
    """One raw row per dict of changes to a good trip; row numbers count from 1."""
    rows = [{**GOOD, "_file_row_number": n, **change} for n, change in enumerate(changes, 1)]
    return spark.createDataFrame([tuple(r[f] for f in schema.names) for r in rows], schema)


def distinct(n: int) -> dict:
    """Changes that make a trip differ from its neighbours in the business key."""
    return {"trip_distance": 5.0 + n / 100}
