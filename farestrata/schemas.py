"""Declared schemas of the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_TRIPS = T.StructType([
    T.StructField("vendorid", T.LongType()),
    T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
    T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
    T.StructField("passenger_count", T.LongType()),
    T.StructField("trip_distance", T.DoubleType()),
    T.StructField("ratecodeid", T.LongType()),
    T.StructField("store_and_fwd_flag", T.StringType()),
    T.StructField("pulocationid", T.LongType()),
    T.StructField("dolocationid", T.LongType()),
    T.StructField("payment_type", T.LongType()),
    T.StructField("fare_amount", T.DoubleType()),
    T.StructField("extra", T.DoubleType()),
    T.StructField("mta_tax", T.DoubleType()),
    T.StructField("tip_amount", T.DoubleType()),
    T.StructField("tolls_amount", T.DoubleType()),
    T.StructField("improvement_surcharge", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("congestion_surcharge", T.DoubleType()),
    T.StructField("airport_fee", T.DoubleType()),
    T.StructField("cbd_congestion_fee", T.DoubleType()),
    T.StructField("_source_file", T.StringType()),
    T.StructField("_file_row_number", T.LongType()),
    T.StructField("_file_last_modified", T.TimestampNTZType()),
    T.StructField("_loaded_at", T.TimestampType()),
])

# The lookup file has a header line but its columns are taken by position.
ZONE_FILE = T.StructType([
    T.StructField("locationid", T.LongType()),
    T.StructField("borough", T.StringType()),
    T.StructField("zone", T.StringType()),
    T.StructField("service_zone", T.StringType()),
])

RAW_ZONES = T.StructType([
    *ZONE_FILE.fields,
    T.StructField("_source_file", T.StringType()),
    T.StructField("_loaded_at", T.TimestampType()),
])

LEDGER = T.StructType([
    T.StructField("source_file", T.StringType(), False),
    T.StructField("dataset", T.StringType()),
    T.StructField("source_period", T.DateType()),
    T.StructField("source_url", T.StringType()),
    T.StructField("etag", T.StringType()),
    T.StructField("content_length", T.LongType()),
    T.StructField("source_last_modified", T.StringType()),
    T.StructField("file_rows", T.LongType()),
    T.StructField("rows_loaded", T.LongType()),
    T.StructField("source_columns", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("attempts", T.LongType()),
    T.StructField("updated_at", T.TimestampType()),
])

VENDORS = T.StructType([
    T.StructField("vendor_id", T.IntegerType()),
    T.StructField("vendor_name", T.StringType()),
])

RATE_CODES = T.StructType([
    T.StructField("rate_code_id", T.IntegerType()),
    T.StructField("rate_code_name", T.StringType()),
    T.StructField("rate_code_description_es", T.StringType()),
])

PAYMENT_TYPES = T.StructType([
    T.StructField("payment_type_id", T.IntegerType()),
    T.StructField("payment_type_name", T.StringType()),
    T.StructField("payment_type_description_es", T.StringType()),
])
