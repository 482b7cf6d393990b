"""Queries over real files: the landing folder, loads that partly fail, code tables in CSV, stored tables that grow columns, and
the checks and gates of stored layers.

The files are written from the order tables, so work grows with them. Nothing here is imported by the library.
"""

from __future__ import annotations

import uuid
from datetime import UTC, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farestrata import refs, session
from farestrata.config import TRIP_COLUMNS, TRIPS_FOLDER, ZONES_FILE, ZONES_FOLDER
from farestrata.functions import base_name, period_of_file
from farestrata.operators import bronze, checks, gold, ledger, silver
from farestrata.operators.dedup import stored_groups
from farestrata.plans import bridge, pipeline, suites
from farestrata.plans.catalog import TRIPS_DATASET, Inputs, _file_of, build_layers, query, reload_march, stored_raw, with_use
from farestrata.sources import landing
from farestrata.sources.files import Files
from farestrata.sources.tables import LOADS, FileTable, new_run
from farestrata.streaming import arrivals

#: Spellings that files use from 1995 on, when they also bring the newest fee and a column that nobody expects.
PUBLISHED = {"vendorid": "VendorID", "ratecodeid": "RatecodeID", "pulocationid": "PULocationID", "airport_fee": "Airport_fee"}
CHANGE = 1995


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{session.shared_folder(spark)}/{label}-{new_run()}"


def publish(trips: DataFrame, folder: str) -> None:
    """Write the trips as monthly files of one landing folder, each in the order of its row numbers."""
    files = Files(trips.sparkSession, folder)
    late = F.year(period_of_file("_source_file")) >= CHANGE
    named = trips.withColumn("_name", base_name("_source_file"))
    eras = (
        (~late, [c for c in TRIP_COLUMNS if c != "cbd_congestion_fee"], []),
        (late, TRIP_COLUMNS, [F.col("store_and_fwd_flag").alias("request_source")]),
    )
    for number, (era, columns, more) in enumerate(eras):
        parts = f"{folder}/parts-{uuid.uuid4().hex}"
        picked = [F.col(c).alias(PUBLISHED.get(c, c) if number else c) for c in columns]
        ordered = named.where(era).repartition("_name").sortWithinPartitions("_name", "_file_row_number")
        with session.tidy(trips.sparkSession):
            ordered.select(*picked, *more, "_name").write.option("compression", "zstd").partitionBy("_name").parquet(parts)
        for part in files.matching(f"{parts}/*/*.parquet"):
            files.move(part, landing.trips_path(folder, part.split("/")[-2].removeprefix("_name=")))
        files.remove(parts)


@query
def landed_scan(data: Inputs) -> DataFrame:
    """All landed files by one scan per set of columns: names in any case, missing and unexpected columns, row numbers."""
    folder = new_folder(data.spark, "landing")
    publish(data.kept_raw, folder)
    rows = landing.scan_all(data.spark, folder, datetime.now(UTC))
    return rows.select("_source_file", "_file_row_number", *TRIP_COLUMNS)


@query
def landed_inventory(data: Inputs) -> DataFrame:
    """The folder before and after a delivery: November is new, March longer, December gone."""
    folder, raw = new_folder(data.spark, "landing"), data.kept_raw
    publish(raw.where(~_file_of(11)), folder)
    before = _kept(landing.inventory(data.spark, folder))
    publish(raw.where(_file_of(11)).union(raw.where(_file_of(3))).union(raw.where(_file_of(3))), folder)
    Files(data.spark, folder).remove(f"{folder}/{TRIPS_FOLDER}/*-12.parquet")
    return ledger.inventory_changes(before, landing.inventory(data.spark, folder))


def _kept(listed: DataFrame) -> DataFrame:
    """A short list, as of now."""
    folder = new_folder(listed.sparkSession, "kept")
    with session.tidy(listed.sparkSession):
        listed.write.parquet(folder)
    return listed.sparkSession.read.schema(listed.schema).parquet(folder)


@query
def load_outcomes(data: Inputs) -> DataFrame:
    """Two loads: all files; then March with other amounts, June broken, December gone. Two months were never published.

    Per file: what the ledger says, whether the last run touched it, and the rows that are in place.
    """
    spark, folder = data.spark, new_folder(data.spark, "landing")
    lake, raw = pipeline.Lake(spark, new_folder(spark, "lake")), data.kept_raw
    publish(raw, folder)
    first, last = data.expected.agg(
        F.date_format(F.min("source_period"), "yyyy-MM"), F.date_format(F.add_months(F.max("source_period"), -1), "yyyy-MM")
    ).first()
    pipeline.load_trips(lake, folder, first, last)
    publish(raw.where(_file_of(3)).withColumn("total_amount", F.col("total_amount") + 1), folder)
    files = Files(spark, folder)
    for broken in files.matching(f"{folder}/{TRIPS_FOLDER}/*-06.parquet"):
        files.overwrite(broken, b"these are no rows")
    files.remove(f"{folder}/{TRIPS_FOLDER}/*-12.parquet")
    try:
        pipeline.load_trips(lake, folder, first, last)
    except pipeline.LoadFailed:
        pass  # June, as planned; the ledger tells
    known = _kept(lake.ledger())
    newest = known.select(F.max("updated_at")).scalar()
    rows = lake.read("raw.trips").groupBy(base_name("_source_file").alias("source_file")).agg(
        F.count("*").alias("rows_now"), F.sum(F.col("total_amount").cast("decimal(18,2)")).alias("total_now"),
        F.max("_file_row_number").alias("last_row"),
    )
    return known.join(rows, "source_file", "left").select(
        "source_file", "source_period", "status", "file_rows", "rows_loaded", "attempts",
        F.split(F.when(F.col("status") != "FAILED", F.col("message")), ";")[0].alias("message"),
        (F.col("updated_at") == newest).alias("in_last_run"), "rows_now", "total_now", "last_row",
    )


@query
def code_tables_from_csv(data: Inputs) -> DataFrame:
    """Vendors with their trips, where the code tables and the zones are CSV files and one vendor isn't listed."""
    spark, folder = data.spark, new_folder(data.spark, "codes")
    tables = refs.code_tables(spark) | {"vendors": refs.vendors(spark).where("vendor_id <> 6")}
    for file, name in (("ref_vendor", "vendors"), ("ref_rate_code", "rate_codes"), ("ref_payment_type", "payment_types")):
        tables[name].coalesce(1).write.option("header", True).csv(f"{folder}/{file}.csv")
    zones = bridge.raw_zones(spark, data.sf_dir).toDF("LocationID", "Borough", "Zone", "service_zone")
    zones.coalesce(1).write.option("header", True).option("quoteAll", True).csv(f"{folder}/{ZONES_FOLDER}/{ZONES_FILE}")
    read = bronze.bronze_zones(landing.scan_zones(spark, folder, datetime.now(UTC)))
    cleaned = silver.clean_zones(read).drop("_source_file", "_loaded_at")
    own = refs.References(**refs.code_tables(spark, folder), zones=cleaned)
    fact = gold.fct_trips(silver.valid_trips(silver.standardized_trips(data.bronze, own)))
    return with_use(gold.dim_vendor(own.vendors), "vendor_key", fact, {"trips": "vendor_key"})


@query
def stored_schema_growth(data: Inputs) -> DataFrame:
    """Loads of three shapes read back as one table: a column that only later files have, and one that becomes wider twice."""
    table = FileTable(data.spark, new_folder(data.spark, "growth"))
    year = F.year(period_of_file("_source_file"))
    kept = data.raw.select("_source_file", "_file_row_number", "vendorid", "pulocationid", "cbd_congestion_fee", "_loaded_at")
    table.replace(kept.where(year < CHANGE).drop("cbd_congestion_fee").withColumn("vendorid", F.col("vendorid").cast("smallint")))
    table.replace(kept.where(year == CHANGE).withColumn("vendorid", F.col("vendorid").cast("int")))
    table.replace(kept.where(year > CHANGE).withColumn("vendorid", F.col("vendorid").cast("bigint")))
    return table.read().select("_source_file", "_file_row_number", "vendorid", "pulocationid", "cbd_congestion_fee")


@query
def arrived_files(data: Inputs) -> DataFrame:
    """The fact from files that arrive in two batches, each noticed by the file trigger and loaded at a time of its own (``arrival``)."""
    spark, folder = data.spark, new_folder(data.spark, "landing")
    lake, seen = pipeline.Lake(spark, new_folder(spark, "lake")), new_folder(spark, "seen")
    early, trips = F.month(period_of_file("_source_file")) <= 6, data.kept_raw
    for batch in (early, ~early):
        publish(trips.where(batch), folder)
        arrivals.follow(lake, folder, seen, job=pipeline.load_trips).awaitTermination()
    raw = lake.read("raw.trips")
    # one row per load
    arrival = F.row_number().over(Window.orderBy("_loaded_at")).alias("arrival")
    loads = raw.select("_loaded_at").distinct().select("_loaded_at", arrival)
    judged = silver.standardized_trips(bronze.bronze_trips(raw), data.references, keep=stored_groups)
    fact = gold.fct_trips(silver.valid_trips(judged))
    return fact.join(loads, "_loaded_at").drop("_loaded_at")


@query
def compacted_loads(data: Inputs) -> DataFrame:
    """All files, two reloads of March and June (without rows) and a load that never became current; then what isn't used is removed.

    Per file: the rows that are read, the loads that are listed and the folders that hold them.
    """
    table = FileTable(data.spark, new_folder(data.spark, "compacted"))
    table.replace(data.raw)
    reload_march(table)
    reload_march(table)
    table.stage(table.read().where(_file_of(9)), new_run())
    table.compact(keep=timedelta(0))
    stored = Files(data.spark, table.data)
    # one name per file
    held = [(name.removeprefix("_part=") + ".parquet",) for run in stored.names_in(table.data)
            for name in stored.names_in(f"{table.data}/{run}") if name.startswith("_part=")]
    folders = data.spark.createDataFrame(held, "file string").groupBy("file").agg(F.count("*").alias("folders"))
    listed = (
        data.spark.read.schema(LOADS).option("recursiveFileLookup", True).parquet(table.loads)
        .groupBy("source_file").agg(F.count("*").alias("listed"))
    )
    rows = table.read().groupBy("_source_file").agg(
        F.count("*").alias("row_count"), F.sum(F.col("total_amount").cast("decimal(18,2)")).alias("total"))
    return (
        listed.join(rows, F.col("source_file") == F.col("_source_file"), "left")
        .join(folders, base_name("source_file") == F.col("file"), "left")
        .select("source_file", F.coalesce("row_count", F.lit(0)).alias("row_count"), "total", "listed",
                F.coalesce("folders", F.lit(0)).alias("folders"))
    )


@query
def ledger_vs_rows_theta(data: Inputs) -> DataFrame:
    """``ledger_vs_rows`` by the condition as written: the name in the table ends in the one in the ledger."""
    return checks.ledger_mismatches_by_suffix(data.raw, data.ledger, TRIPS_DATASET)


@query
def ledger_vs_rows_long_list(data: Inputs) -> DataFrame:
    """The same with a list of files too long to be broadcast."""
    return checks.ledger_mismatches_by_suffix(data.raw, data.ledger, TRIPS_DATASET, most_broadcast=0)


@query
def first_run_files(data: Inputs) -> DataFrame:
    """While the target is empty, every file is taken."""
    changed = ledger.rows_of_changed_files(data.raw, data.raw.where(F.lit(False)))
    return changed.groupBy("_source_file").agg(F.count("*").alias("row_count"))


@query
def check_all_layers(data: Inputs) -> DataFrame:
    """All declared checks and reconciliations of the stored layers.

    Afterwards zone 7 was lost from silver and hour 3 from gold; the calendar is the default one, which begins after the orders.
    """
    lake = stored_raw(data, data.raw)
    build_layers(lake)
    lake.table("silver.zones").replace(lake.read("silver.zones").where("location_id <> 7"))
    lake.table("gold.dim_time").replace(lake.read("gold.dim_time").where("time_key <> 3"))
    # a few rows per layer
    return reduce(DataFrame.union, [_kept(pipeline.check_layer(lake, layer)) for layer in suites.LAYERS])


@query
def gated_layers(data: Inputs) -> DataFrame:
    """February brings trips without a distance, which breaks no rule but a check of the valid trips: gold is not built."""
    raw = data.raw.withColumn("trip_distance", F.when(~_file_of(2), F.col("trip_distance")))
    lake = stored_raw(data, raw)
    layer, broken = None, []
    try:
        pipeline.run_layers(lake)
    except pipeline.LayerCheckFailed as stop:
        layer, broken = stop.layer, stop.broken
    facts = {"bronze": "bronze.trips", "silver": "silver.valid", "gold": "gold.fct_trips"}
    built = ",".join(name for name, table in facts.items() if lake.table(table).current())
    # one row per broken check
    rows = [(layer, b.check, b.table, b.column, b.failures, built) for b in broken]
    return data.spark.createDataFrame(rows, "layer string, check string, table string, column string, failures bigint, built string")
