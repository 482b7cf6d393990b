"""Questions on the star schema.

Each one first sums the fact by its foreign keys, where partial aggregation leaves a few rows per task, and only
then meets the dimensions; the join therefore sees one row per key combination, not one per trip.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farestrata.functions import ratio_percent


@dataclass(frozen=True)
class Star:
    fact: DataFrame
    date: DataFrame
    time: DataFrame
    zone: DataFrame
    payment_type: DataFrame


def _trips() -> Column:
    return F.sum("trip_count").alias("viajes")


def _mean(total: str, count: str) -> Column:
    return F.round(F.sum(total) / F.sum(count), 2)


def monthly_revenue(star: Star) -> DataFrame:
    daily = star.fact.groupBy("pickup_date_key").agg(
        _trips(), F.sum("total_amount").alias("revenue"), F.count("total_amount").alias("tickets")
    )
    return (
        daily.join(star.date, daily.pickup_date_key == star.date.date_key)
        .groupBy("year_month")
        .agg(
            F.sum("viajes").alias("viajes"),
            F.round(F.sum("revenue"), 2).alias("ingreso_total_usd"),
            _mean("revenue", "tickets").alias("ticket_promedio_usd"),
        )
        .orderBy("year_month")
    )


def demand_by_day_part(star: Star) -> DataFrame:
    hourly = star.fact.groupBy("pickup_date_key", "pickup_time_key").agg(_trips())
    return (
        hourly.join(star.date, hourly.pickup_date_key == star.date.date_key)
        .join(star.time, hourly.pickup_time_key == star.time.time_key)
        .groupBy("day_of_week", "day_name", "day_part")
        .agg(F.sum("viajes").alias("viajes"))
        .orderBy("day_of_week", "day_part")
        .drop("day_of_week")
    )


def top_routes(star: Star, limit: int = 10) -> DataFrame:
    """The busiest zone pairs; ties are settled by the zone names."""
    pairs = star.fact.groupBy("pickup_zone_key", "dropoff_zone_key").agg(
        _trips(), F.sum("trip_distance_miles").alias("miles"), F.count("trip_distance_miles").alias("measured")
    )
    pickup = star.zone.select(F.col("zone_key").alias("pickup_zone_key"), F.col("zone_name").alias("zona_recogida"))
    dropoff = star.zone.select(F.col("zone_key").alias("dropoff_zone_key"), F.col("zone_name").alias("zona_destino"))
    return (
        pairs.join(pickup, "pickup_zone_key")
        .join(dropoff, "dropoff_zone_key")
        .groupBy("zona_recogida", "zona_destino")
        .agg(F.sum("viajes").alias("viajes"), _mean("miles", "measured").alias("distancia_promedio_millas"))
        .orderBy(F.desc("viajes"), "zona_recogida", "zona_destino")
        .limit(limit)
    )


def tip_pct_by_payment(star: Star) -> DataFrame:
    paid = star.fact.groupBy("payment_type_key").agg(
        _trips(), F.sum("tip_amount").alias("tips"), F.sum("fare_amount").alias("fares")
    )
    return (
        paid.join(star.payment_type, "payment_type_key")
        .groupBy("payment_type_description")
        .agg(F.sum("viajes").alias("viajes"), ratio_percent(F.sum("tips"), F.sum("fares")).alias("propina_pct"))
        .orderBy(F.desc("viajes"), "payment_type_description")
    )


def surcharge_by_month(star: Star) -> DataFrame:
    daily = star.fact.groupBy("pickup_date_key").agg(
        F.sum("cbd_congestion_fee_amount").alias("charged"),
        F.count_if(F.col("cbd_congestion_fee_amount") > 0).alias("charged_trips"),
    )
    return (
        daily.join(star.date, daily.pickup_date_key == star.date.date_key)
        .groupBy("year_month")
        .agg(
            F.round(F.sum("charged"), 2).alias("cargo_cbd_usd"),
            F.sum("charged_trips").alias("viajes_con_cargo"),
        )
        .orderBy("year_month")
    )
