"""Trip-shaped inputs derived from the order tables, for queries and benchmarks.

Real input comes through :mod:`farestrata.sources.landing`. Here every order line becomes a trip, with missing
values, unknown codes, copies and out-of-range amounts placed by its own columns, so all quality rules fire.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farestrata.refs import literal_rows


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def number_lines(lines: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Give every order line a number of its own that depends only on the data.

    Numbering a whole month in one window would put each month on one task. Lines are numbered inside small slots
    (order, line number, part of the supplier key) and the slot is made part of the number: unique, not dense.
    ``lines`` may be joined with orders before: then they are partitioned by order already and don't move again.
    """
    span = lineitem.select((F.max("l_orderkey") + 1).alias("span")).scalar()
    slot = [F.col("l_orderkey"), F.col("l_linenumber") % 8, F.col("l_suppkey") % 16]
    window = Window.partitionBy(*slot).orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_shipdate", "l_returnflag", "l_linestatus",
    )
    rank = (F.row_number().over(window) - 1).cast("bigint")
    return lines.withColumn("line_id", ((rank * span + slot[0]) * 8 + slot[1]) * 16 + slot[2])


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_custkey")
    pickup = F.expr("""
        case when not (l_linestatus = 'F' and l_tax = 0.01 and l_linenumber = 6) then
          timestampadd(SECOND, l_partkey % 24 * 3600 + l_suppkey % 60 * 60, o_orderdate) end""")
    period = F.trunc(
        F.to_date(F.expr("if(l_linenumber = 2 and l_tax = 0.06, l_shipdate, o_orderdate)")), "MM"
    )
    # a supplier in fifty reports every trip twice
    copies = F.explode(F.expr("if(l_suppkey % 50 = 0, array(0, 1), array(0))"))
    trips = (
        number_lines(lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey), lineitem)
        .withColumns({"pickup": pickup, "period": period})
        .withColumn("copy_no", copies)
    )
    return trips.selectExpr(
        "l_suppkey % 9 - 1 as vendorid",
        "pickup as tpep_pickup_datetime",
        """case when not (l_linestatus = 'O' and l_tax = 0.03 and l_linenumber = 1) then
             timestampadd(SECOND, (l_orderkey * 7919 + l_partkey * 31) % 90000 - 1500, pickup)
           end as tpep_dropoff_datetime""",
        "cast(nullif(l_linenumber, 3) as bigint) as passenger_count",
        "(l_quantity - 2) * 4.25D as trip_distance",
        "if(l_partkey % 8 = 7, 99, nullif(l_partkey % 8, 0)) as ratecodeid",
        "case l_returnflag when 'A' then ' y' when 'N' then 'N ' end as store_and_fwd_flag",
        "case o_custkey % 30 when 29 then 264 when 28 then null else o_custkey % 30 end as pulocationid",
        "l_suppkey % 27 as dolocationid",
        "nullif(l_orderkey % 9, 8) as payment_type",
        "if(l_tax = 0.08 and l_linenumber = 5, null, floor(l_extendedprice + 0.5D) / 100D) as fare_amount",
        "if(l_linenumber > 1, l_linenumber * 0.5D, null) as extra",
        "0.5D as mta_tax",
        "if(l_returnflag = 'R' and l_tax = 0.07, -1D, 1D) * floor(l_tax * 100D + 0.5D) as tip_amount",
        "if(l_suppkey % 3 = 0, 6.25D, null) as tolls_amount",
        "1.0D as improvement_surcharge",
        "floor(l_extendedprice * l_discount * 10D + 0.5D) / 100D as total_amount",
        "if(l_linestatus = 'O', 2.5D, null) as congestion_surcharge",
        "if(l_partkey % 10 = 0, 1.75D, null) as airport_fee",
        "if(l_suppkey % 4 = 0, 0.75D, null) as cbd_congestion_fee",
        "concat('yellow/yellow_tripdata_', left(string(period), 7), '.parquet') as _source_file",
        "line_id * 2 + copy_no as _file_row_number",
        "cast(date_add(period, 35) as timestamp_ntz) as _file_last_modified",
        "cast(date_add(period, 40) as timestamp_ntz) as _loaded_at",
    )


def raw_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A zone per nation with the usual spellings of "no value", and the two unknown zones."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    named = nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
        "cast(n_nationkey as bigint) as locationid",
        """case n_nationkey % 7 when 0 then 'N/A' when 1 then concat(' ', r_name, ' ') when 2 then ''
             when 3 then 'Unknown' else r_name end as borough""",
        "case n_nationkey % 5 when 0 then 'N/A' when 1 then '' else n_name end as zone",
        "case n_nationkey % 3 when 0 then 'Boro Zone' when 1 then 'Yellow Zone' else 'N/A' end as service_zone",
    )
    unknown = literal_rows(
        spark, [(264, "Unknown", "N/A", "N/A"), (265, "N/A", "Outside of NYC", "N/A")], named.schema
    )
    return named.union(unknown)
