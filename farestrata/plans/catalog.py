"""The registered queries: every operator, run over whole tables.

Checks and load operators run against copies with planted faults, so that their results are not empty.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farestrata import refs, session
from farestrata.config import FAILED, LOADED, NOT_AVAILABLE, SKIPPED, TRIP_COLUMNS, TRIPS_DATASET, Limits
from farestrata.functions import base_name, period_of_file
from farestrata.operators import bronze, checks, gold, ledger, marts, silver
from farestrata.operators.checks import Relationship, TableChecks
from farestrata.operators.dedup import stored_groups
from farestrata.plans import bridge, pipeline
from farestrata.sources.tables import FileTable, new_run

QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {}


def query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build):
        return lambda spark, sf_dir: plain_numbers(build(Inputs(spark, sf_dir)))

    return {name: bind(build) for name, build in QUERIES.items()}


def plain_numbers(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so results compare with engines that widen decimals differently."""
    return df.select(*[
        F.col(f"`{name}`").cast("double").alias(name) if kind.startswith("decimal") else F.col(f"`{name}`")
        for name, kind in df.dtypes
    ])


class Inputs:
    """The layers as lazy frames over one data folder; Spark prunes what a query does not use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def raw(self) -> DataFrame:
        return bridge.raw_trips(self.spark, self.sf_dir)

    @cached_property
    def kept_raw(self) -> DataFrame:
        """The raw trips, derived once and stored, for what reads them more than once."""
        folder = f"{session.shared_folder(self.spark)}/raw-{new_run()}"
        with session.tidy(self.spark):
            self.raw.write.option("compression", "zstd").parquet(folder)
        return self.spark.read.schema(self.raw.schema).parquet(folder)

    @cached_property
    def bronze(self) -> DataFrame:
        return bronze.bronze_trips(self.raw)

    @cached_property
    def zones(self) -> DataFrame:
        return silver.clean_zones(bridge.raw_zones(self.spark, self.sf_dir))

    @cached_property
    def references(self) -> refs.References:
        return refs.builtin(self.spark, self.zones)

    @cached_property
    def typed(self) -> DataFrame:
        return silver.typed(self.bronze)

    @cached_property
    def standardized(self) -> DataFrame:
        return silver.standardize(self.typed, self.references)

    @cached_property
    def judged(self) -> DataFrame:
        """Judged from stored rows, so that the wide rows don't move to learn which of them are copies."""
        return silver.standardized_trips(bronze.bronze_trips(self.kept_raw), self.references, keep=stored_groups)

    @cached_property
    def valid(self) -> DataFrame:
        return silver.valid_trips(self.judged)

    @cached_property
    def fact(self) -> DataFrame:
        return gold.fct_trips(self.valid)

    @cached_property
    def calendar(self) -> DataFrame:
        """Whole years around the order dates."""
        dates = bridge.table(self.spark, self.sf_dir, "orders").agg(
            F.trunc(F.to_date(F.min("o_orderdate")), "YEAR").alias("start"),
            F.add_months(F.trunc(F.to_date(F.max("o_orderdate")), "YEAR"), 12).alias("end"),
        )
        return gold.calendar_days(dates)

    @cached_property
    def star(self) -> marts.Star:
        return marts.Star(
            fact=self.fact,
            date=self.calendar,
            time=gold.dim_time(self.spark),
            zone=gold.dim_zone(self.zones),
            payment_type=gold.dim_payment_type(self.references.payment_types),
        )

    # --- what a landing folder and a ledger would report about the derived files

    @cached_property
    def files(self) -> DataFrame:
        counted = self.raw.groupBy("_source_file").agg(F.count("*").alias("n"))
        period = period_of_file("_source_file")
        return counted.select(
            base_name("_source_file").alias("source_file"),
            F.col("_source_file").alias("path"),
            period.alias("source_period"),
            F.month(period).alias("m"),
            "n",
        )

    @cached_property
    def ledger(self) -> DataFrame:
        """July never loaded, May failed, August was not published, April logged no rows, September one too many."""
        m, n = F.col("m"), F.col("n")
        published = F.col("m") != 8
        return self.files.where(m != 7).select(
            "source_file",
            F.lit(TRIPS_DATASET).alias("dataset"),
            "source_period",
            F.concat(F.lit("landing/"), "path").alias("source_url"),
            F.when(published, _fingerprint()).alias("etag"),
            F.when(published, n * 100).alias("content_length"),
            F.lit(None).cast("string").alias("source_last_modified"),
            F.when(~m.isin(5, 8), n).alias("file_rows"),
            F.when(m == 4, 0).when(m == 9, n + 1).when(~m.isin(5, 8), n).alias("rows_loaded"),
            F.lit(None).cast("string").alias("source_columns"),
            F.when(m == 5, FAILED).when(m == 8, NOT_AVAILABLE).otherwise(LOADED).alias("status"),
            F.lit("ok").alias("message"),
            F.lit(1).cast("bigint").alias("attempts"),
            F.date_add("source_period", 41).cast("timestamp_ntz").alias("updated_at"),
        )

    @cached_property
    def inventory(self) -> DataFrame:
        """December is gone, March has a new fingerprint, June a new size."""
        m = F.col("m")
        return self.files.where(m != 12).select(
            "source_file",
            F.when(m == 3, _fingerprint("new")).otherwise(_fingerprint()).alias("etag"),
            (F.col("n") * 100 + F.when(m == 6, 1).otherwise(0)).alias("content_length"),
        )

    @cached_property
    def expected(self) -> DataFrame:
        """Every month of the data and three more."""
        return ledger.months_between(self.files.agg(
            F.date_format(F.min("source_period"), "yyyy-MM").alias("first"),
            F.date_format(F.add_months(F.max("source_period"), 3), "yyyy-MM").alias("last"),
        ))

    @cached_property
    def plan(self) -> DataFrame:
        return ledger.load_plan(self.expected, self.inventory, self.ledger, ledger.row_counts(self.raw))

    @cached_property
    def results(self) -> DataFrame:
        """Outcome of the plan, had the September files failed to load."""
        done = self.plan.join(self.files.select("source_file", "m", "n"), "source_file", "left")
        load, failed = F.col("action") == ledger.LOAD, F.coalesce(F.col("m") == 9, F.lit(False))
        return done.select(
            "source_file",
            "source_period",
            "n",
            "etag",
            "content_length",
            F.when(load & failed, FAILED).when(load, LOADED).otherwise(F.col("action")).alias("status"),
            F.when(load & failed, 0).when(load, F.col("n")).otherwise(F.col("rows_kept")).alias("rows"),
        )


def _fingerprint(*salt: str) -> Column:
    return F.md5(F.concat_ws("-", *[F.lit(s) for s in salt], "source_file", F.col("n").cast("string")))


def _file_of(*months: int) -> Column:
    return F.month(period_of_file("_source_file")).isin(*months)


# --- bronze -----------------------------------------------------------------------------------------------


@query
def bronze_trips(data: Inputs) -> DataFrame:
    return data.bronze


@query
def append_new_columns(data: Inputs) -> DataFrame:
    """Files before 2000 were stored without the fee column that later files bring."""
    late = F.year(period_of_file("_source_file")) >= 2000
    stored = data.raw.where(~late).drop("cbd_congestion_fee")
    both = bronze.append_new_columns(stored, data.raw.where(late))
    return both.groupBy("_source_file").agg(
        F.count("*").alias("row_count"), F.count("cbd_congestion_fee").alias("with_cbd_fee")
    )


@query
def schema_drift_report(data: Inputs) -> DataFrame:
    landed = (
        data.raw.select(*TRIP_COLUMNS)
        .drop("cbd_congestion_fee")
        .withColumnsRenamed({"airport_fee": "Airport_fee", "vendorid": "VendorID"})
        .withColumn("request_source", F.col("store_and_fwd_flag"))
    )
    return bronze.schema_drift_report(landed)


# --- silver -----------------------------------------------------------------------------------------------


@query
def typed_trips(data: Inputs) -> DataFrame:
    return data.typed


@query
def unknown_member_lookup(data: Inputs) -> DataFrame:
    return data.standardized.select("trip_id", *[code.column for code in silver.CODES])


@query
def standardized_trips(data: Inputs) -> DataFrame:
    return data.standardized


@query
def imputation_list(data: Inputs) -> DataFrame:
    return data.standardized.select("trip_id", "dq_imputations")


@query
def dedup_first(data: Inputs) -> DataFrame:
    marked = silver.mark_duplicates(data.standardized)
    return marked.select("trip_id", "_source_file", "_file_row_number", "dq_duplicate")


@query
def quality_flags(data: Inputs) -> DataFrame:
    return data.judged.select("trip_id", *silver.FLAGS)


@query
def rejection_reason(data: Inputs) -> DataFrame:
    return data.judged.select("trip_id", "rejection_reason", "dq_issues", "is_valid")


@query
def judged_trips(data: Inputs) -> DataFrame:
    return data.judged


@query
def valid_trips(data: Inputs) -> DataFrame:
    return data.valid


@query
def rejected_trips(data: Inputs) -> DataFrame:
    return silver.rejected_trips(data.judged)


@query
def quality_summary(data: Inputs) -> DataFrame:
    return silver.quality_summary(data.judged)


@query
def zones_clean(data: Inputs) -> DataFrame:
    return data.zones


# --- gold -------------------------------------------------------------------------------------------------


def with_use(dimension: DataFrame, key: str, fact: DataFrame, uses: dict[str, str]) -> DataFrame:
    """Dimension members with the number of trips that point to them, per foreign key."""
    for name, foreign_key in uses.items():
        used = fact.groupBy(F.col(foreign_key).alias(key)).agg(F.count("*").alias(name))
        dimension = dimension.join(used, key, "left").fillna(0, [name])
    return dimension


@query
def dim_date(data: Inputs) -> DataFrame:
    return with_use(data.calendar, "date_key", data.fact, {"pickups": "pickup_date_key"})


@query
def dim_time(data: Inputs) -> DataFrame:
    return with_use(data.star.time, "time_key", data.fact, {"pickups": "pickup_time_key"})


@query
def dim_zone(data: Inputs) -> DataFrame:
    uses = {"pickups": "pickup_zone_key", "dropoffs": "dropoff_zone_key"}
    return with_use(data.star.zone, "zone_key", data.fact, uses)


@query
def dim_vendor(data: Inputs) -> DataFrame:
    vendors = gold.dim_vendor(data.references.vendors)
    return with_use(vendors, "vendor_key", data.fact, {"trips": "vendor_key"})


@query
def dim_rate_code(data: Inputs) -> DataFrame:
    rates = gold.dim_rate_code(data.references.rate_codes)
    return with_use(rates, "rate_code_key", data.fact, {"trips": "rate_code_key"})


@query
def dim_payment_type(data: Inputs) -> DataFrame:
    return with_use(data.star.payment_type, "payment_type_key", data.fact, {"trips": "payment_type_key"})


@query
def fct_trips(data: Inputs) -> DataFrame:
    return data.fact


# --- marts ------------------------------------------------------------------------------------------------


@query
def monthly_revenue(data: Inputs) -> DataFrame:
    return marts.monthly_revenue(data.star)


@query
def demand_by_day_part(data: Inputs) -> DataFrame:
    return marts.demand_by_day_part(data.star)


@query
def top_routes(data: Inputs) -> DataFrame:
    return marts.top_routes(data.star)


@query
def tip_pct_by_payment(data: Inputs) -> DataFrame:
    return marts.tip_pct_by_payment(data.star)


@query
def surcharge_by_month(data: Inputs) -> DataFrame:
    return marts.surcharge_by_month(data.star)


# --- checks -----------------------------------------------------------------------------------------------


@query
def check_not_null(data: Inputs) -> DataFrame:
    columns = (*TRIP_COLUMNS, "_source_file", "_file_row_number", "_loaded_at")
    return checks.run_checks(data.raw, TableChecks("raw.trips", not_null=columns))


@query
def check_unique(data: Inputs) -> DataFrame:
    """June was loaded twice."""
    twice = data.bronze.union(data.bronze.where(_file_of(6)))
    return checks.run_checks(twice, TableChecks("bronze.trips", unique=("_record_id", "tpep_pickup_datetime")))


@query
def check_relationships(data: Inputs) -> DataFrame:
    tables = {code.table: getattr(data.references, code.table) for code in silver.CODES}
    order = ("vendor_id", "rate_code_id", "pickup_location_id", "dropoff_location_id", "payment_type_id")
    codes = {code.column: code for code in silver.CODES}
    relationships = [Relationship(codes[c].reported, codes[c].table, codes[c].key) for c in order]
    return checks.run_checks(data.typed, TableChecks("silver.typed", relationships=relationships), tables)


@query
def check_accepted_values(data: Inputs) -> DataFrame:
    """Empty trips and the flag N are left out of the accepted lists."""
    accepted = {
        "rejection_reason": [r for r in silver.REASONS if r != "EMPTY_TRIP"],
        "store_and_fwd_flag_reported": ["Y"],
    }
    return checks.run_checks(data.judged, TableChecks("silver.standardized", accepted_values=accepted))


@query
def check_accepted_range(data: Inputs) -> DataFrame:
    limits = Limits()
    ranges = {
        "passenger_count_reported": (1, limits.max_passengers),
        "trip_distance_miles": (0, limits.max_trip_miles),
    }
    return checks.run_checks(data.standardized, TableChecks("silver.standardized", accepted_range=ranges))


@query
def check_expression(data: Inputs) -> DataFrame:
    expressions = ("dropoff_datetime > pickup_datetime", "total_amount >= 0 and fare_amount >= 0")
    return checks.run_checks(data.standardized, TableChecks("silver.standardized", expressions=expressions))


@query
def reconcile_counts(data: Inputs) -> DataFrame:
    """Raw lost March; bronze lost February and the January rows without a payment type."""
    lost = _file_of(2) | (_file_of(1) & F.col("payment_type").isNull())
    return checks.count_mismatches(
        data.raw.where(~_file_of(3)), data.bronze.where(~lost), "raw_rows", "bronze_rows"
    )


@query
def reconcile_amounts(data: Inputs) -> DataFrame:
    """In the fact, April trips cost one more and May is missing."""
    surplus = F.when(_file_of(4), F.col("total_amount") + 1).otherwise(F.col("total_amount"))
    fact = data.fact.where(~_file_of(5)).withColumn("total_amount", surplus)
    return checks.amount_mismatches(data.valid, fact)


@query
def standardized_keeps_all(data: Inputs) -> DataFrame:
    """Records without a pickup time were dropped on the way."""
    kept = data.standardized.where(F.col("pickup_datetime").isNotNull())
    return checks.count_mismatches(data.bronze, kept, "bronze_rows", "silver_rows")


@query
def duplicate_business_keys(data: Inputs) -> DataFrame:
    return checks.repeated_business_keys(data.standardized, silver.BUSINESS_KEY)


@query
def missing_files(data: Inputs) -> DataFrame:
    """February never reached the fact."""
    return checks.files_missing_from(data.fact.where(~_file_of(2)), data.ledger, TRIPS_DATASET)


@query
def ledger_vs_rows(data: Inputs) -> DataFrame:
    return checks.ledger_mismatches(data.raw, data.ledger, TRIPS_DATASET)


# --- loading ----------------------------------------------------------------------------------------------


@query
def expected_months_missing(data: Inputs) -> DataFrame:
    return ledger.missing_months(data.expected, data.inventory)


@query
def changed_files(data: Inputs) -> DataFrame:
    """The target holds the files before 2000."""
    target = data.raw.where(F.year(period_of_file("_source_file")) < 2000)
    changed = ledger.rows_of_changed_files(data.raw, target)
    return changed.groupBy("_source_file").agg(F.count("*").alias("row_count"))


@query
def load_plan(data: Inputs) -> DataFrame:
    return data.plan


@query
def load_summary(data: Inputs) -> DataFrame:
    return ledger.load_summary(data.results)


@query
def ledger_upsert(data: Inputs) -> DataFrame:
    status = F.col("status")
    loaded = F.when(status == LOADED, F.col("n"))
    nothing = F.lit(None).cast("string")
    entries = data.results.where(status != SKIPPED).select(
        "source_file",
        F.lit(TRIPS_DATASET).alias("dataset"),
        "source_period",
        F.concat(F.lit("landing/yellow/"), "source_file").alias("source_url"),
        "etag",
        "content_length",
        nothing.alias("source_last_modified"),
        loaded.alias("file_rows"),
        loaded.alias("rows_loaded"),
        nothing.alias("source_columns"),
        "status",
        F.when(status == FAILED, F.repeat(F.lit("x"), F.lit(2500))).otherwise("ok").alias("message"),
        F.date_add("source_period", 60).cast("timestamp_ntz").alias("updated_at"),
    )
    return ledger.upsert(data.ledger, entries)


@query
def incremental_replace(data: Inputs) -> DataFrame:
    """Store all files, then reload March with other amounts and June without any row, and read back."""
    table = FileTable(data.spark, f"{session.shared_folder(data.spark)}/incremental-{new_run()}")
    table.replace(data.raw)
    reload_march(table)
    return table.read()


def reload_march(table: FileTable) -> None:
    """March comes again with other amounts, June without any row; both from the stored rows."""
    again = [name for name in table.current() if name[-11:] in ("-03.parquet", "-06.parquet")]
    march = table.read(again).where(_file_of(3)).withColumns({
        "total_amount": F.col("total_amount") + 1,
        "_loaded_at": F.col("_loaded_at") + F.expr("interval 30 days"),
    })
    table.replace(march, again, gathered=True)


def stored_raw(data: Inputs, trips: DataFrame) -> pipeline.Lake:
    """A lake with raw tables alone."""
    lake = pipeline.Lake(data.spark, f"{session.shared_folder(data.spark)}/layers-{new_run()}")
    lake.table("raw.trips").replace(trips)
    lake.table("raw.zones").replace(
        bridge.raw_zones(data.spark, data.sf_dir).withColumns({
            "_source_file": F.lit("zones"), "_loaded_at": F.current_timestamp(),
        })
    )
    return lake


def stored_layers(data: Inputs) -> pipeline.Lake:
    """Raw, bronze, silver and gold as stored tables, built from all files. Nothing else reads them, so superseded rows need not stay."""
    lake = stored_raw(data, data.raw)
    lake.keep = timedelta(0)
    build_layers(lake)
    return lake


def build_layers(lake: pipeline.Lake, full_refresh: bool = False) -> None:
    for build in pipeline.BUILDERS.values():
        build(lake, full_refresh)


@query
def layered_reload(data: Inputs) -> DataFrame:
    """The fact after all files were stored layer by layer, and March and June were loaded again."""
    lake = stored_layers(data)
    reload_march(lake.table("raw.trips"))
    build_layers(lake)
    return lake.read("gold.fct_trips")


@query
def layered_full_refresh(data: Inputs) -> DataFrame:
    """The fact after the limits were lowered and all layers were built anew from the stored raw rows."""
    lake = stored_layers(data)
    lake.limits = Limits(max_trip_miles=100)
    build_layers(lake, full_refresh=True)
    return lake.read("gold.fct_trips")
