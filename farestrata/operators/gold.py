"""Gold: the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farestrata.config import AIRPORT_RATES, CARD_PAYMENT, Calendar
from farestrata.functions import date_key, day_name_es, iso_day_of_week, month_name_es, surrogate_key
from farestrata.operators.silver import MONEY

# First and last hour of each part of the day, and the peak hours.
DAY_PARTS = (("Madrugada", 0, 5), ("Mañana", 6, 11), ("Tarde", 12, 17), ("Noche", 18, 23))
PEAK_HOURS = ((7, 9), (16, 19))


def dim_date(spark: SparkSession, calendar: Calendar = Calendar()) -> DataFrame:
    return calendar_days(
        spark.range(1).select(
            F.to_date(F.lit(calendar.start)).alias("start"), F.to_date(F.lit(calendar.end)).alias("end")
        )
    )


def calendar_days(bounds: DataFrame) -> DataFrame:
    """Date dimension over ``[start, end)`` taken from a one-row frame."""
    spine = bounds.select(
        F.explode(F.sequence("start", "end", F.expr("interval 1 day"))).alias("full_date"), "end"
    ).where("full_date < end")
    iso_day = iso_day_of_week("full_date")
    return spine.select(
        date_key("full_date").alias("date_key"),
        "full_date",
        F.year("full_date").alias("calendar_year"),
        F.quarter("full_date").alias("calendar_quarter"),
        F.month("full_date").alias("calendar_month"),
        month_name_es(F.month("full_date")).alias("month_name"),
        F.date_format("full_date", "yyyy-MM").alias("year_month"),
        F.dayofmonth("full_date").alias("day_of_month"),
        iso_day.alias("day_of_week"),
        day_name_es(iso_day).alias("day_name"),
        F.weekofyear("full_date").alias("iso_week"),
        iso_day.isin(6, 7).alias("is_weekend"),
    )


def dim_time(spark: SparkSession) -> DataFrame:
    hour = F.col("hour_of_day")
    padded = F.lpad(hour.cast("string"), 2, "0")
    day_part = F.coalesce(*[F.when(hour.between(first, last), name) for name, first, last in DAY_PARTS])
    (morning, noon), (evening, night) = PEAK_HOURS
    return spark.range(24).select(F.col("id").cast("int").alias("hour_of_day")).select(
        hour.alias("time_key"),
        hour,
        F.concat(padded, F.lit(":00 - "), padded, F.lit(":59")).alias("hour_label"),
        day_part.alias("day_part"),
        (hour.between(morning, noon) | hour.between(evening, night)).alias("is_peak_hour"),
    )


def dim_zone(zones: DataFrame) -> DataFrame:
    return zones.select(
        surrogate_key("location_id").alias("zone_key"),
        "location_id",
        "borough",
        "zone_name",
        "service_zone",
        "is_airport",
        "is_unknown_location",
    )


def dim_vendor(vendors: DataFrame) -> DataFrame:
    return vendors.select(surrogate_key("vendor_id").alias("vendor_key"), "vendor_id", "vendor_name")


def dim_rate_code(rate_codes: DataFrame) -> DataFrame:
    return rate_codes.select(
        surrogate_key("rate_code_id").alias("rate_code_key"),
        "rate_code_id",
        "rate_code_name",
        F.col("rate_code_description_es").alias("rate_code_description"),
        F.col("rate_code_id").isin(*AIRPORT_RATES).alias("is_airport_rate"),
    )


def dim_payment_type(payment_types: DataFrame) -> DataFrame:
    return payment_types.select(
        surrogate_key("payment_type_id").alias("payment_type_key"),
        "payment_type_id",
        "payment_type_name",
        F.col("payment_type_description_es").alias("payment_type_description"),
        (F.col("payment_type_id") == CARD_PAYMENT).alias("is_card_payment"),
    )


def fct_trips(valid: DataFrame) -> DataFrame:
    """One row per valid trip. Foreign keys are computed, so the build has no join and no shuffle."""
    return valid.select(
        F.col("trip_id").alias("trip_key"),
        date_key("pickup_datetime").alias("pickup_date_key"),
        F.hour("pickup_datetime").alias("pickup_time_key"),
        date_key("dropoff_datetime").alias("dropoff_date_key"),
        F.hour("dropoff_datetime").alias("dropoff_time_key"),
        surrogate_key("pickup_location_id").alias("pickup_zone_key"),
        surrogate_key("dropoff_location_id").alias("dropoff_zone_key"),
        surrogate_key("vendor_id").alias("vendor_key"),
        surrogate_key("rate_code_id").alias("rate_code_key"),
        surrogate_key("payment_type_id").alias("payment_type_key"),
        "pickup_datetime",
        "dropoff_datetime",
        "is_store_and_forward",
        F.lit(1).alias("trip_count"),
        "passenger_count",
        "trip_distance_miles",
        "trip_duration_minutes",
        *MONEY,
        "_source_file",
        "_source_period",
        "_loaded_at",
    )
