"""Reference code tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from farestrata import schemas

# Technology providers.
VENDORS = [
    (1, "Creative Mobile Technologies, LLC"),
    (2, "Curb Mobility, LLC"),
    (6, "Myle Technologies Inc"),
    (7, "Helix"),
    (-1, "Unknown"),
]

# Rate codes.
RATE_CODES = [
    (1, "Standard rate", "Tarifa estándar"),
    (2, "JFK", "Tarifa fija aeropuerto JFK"),
    (3, "Newark", "Aeropuerto de Newark"),
    (4, "Nassau or Westchester", "Nassau o Westchester"),
    (5, "Negotiated fare", "Tarifa negociada"),
    (6, "Group ride", "Viaje compartido"),
    (99, "Null/unknown", "Desconocido"),
]

# Payment types.
PAYMENT_TYPES = [
    (0, "Flex Fare trip", "Tarifa flexible"),
    (1, "Credit card", "Tarjeta de crédito"),
    (2, "Cash", "Efectivo"),
    (3, "No charge", "Sin cargo"),
    (4, "Dispute", "Disputa"),
    (5, "Unknown", "Desconocido"),
    (6, "Voided trip", "Viaje anulado"),
]


@dataclass(frozen=True)
class References:
    """The code tables and the cleaned zones that trips are standardised against."""

    vendors: DataFrame
    rate_codes: DataFrame
    payment_types: DataFrame
    zones: DataFrame


def literal_rows(spark: SparkSession, rows: list[tuple], schema: StructType) -> DataFrame:
    """A few rows as literals of the plan.

    Spark knows the size of literals, so joins broadcast them; ``createDataFrame`` rows have no known size and
    would make the large side shuffle.
    """
    fields = schema.fields
    structs = [
        F.struct(*[F.lit(value).cast(f.dataType).alias(f.name) for value, f in zip(row, fields, strict=True)])
        for row in rows
    ]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*structs)))


def vendors(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, VENDORS, schemas.VENDORS)


def rate_codes(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, RATE_CODES, schemas.RATE_CODES)


def payment_types(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, PAYMENT_TYPES, schemas.PAYMENT_TYPES)


def code_tables(spark: SparkSession, folder: str | None = None) -> dict[str, DataFrame]:
    """The built-in code tables, or those that a user maintains as CSV files with a header in ``folder``."""
    if folder is None:
        return {"vendors": vendors(spark), "rate_codes": rate_codes(spark), "payment_types": payment_types(spark)}

    def read(name: str, schema: StructType) -> DataFrame:
        return spark.read.schema(schema).options(header=True, enforceSchema=False, mode="FAILFAST").csv(f"{folder}/{name}.csv")

    return {
        "vendors": read("ref_vendor", schemas.VENDORS),
        "rate_codes": read("ref_rate_code", schemas.RATE_CODES),
        "payment_types": read("ref_payment_type", schemas.PAYMENT_TYPES),
    }


def builtin(spark: SparkSession, zones: DataFrame) -> References:
    return References(**code_tables(spark), zones=zones)
