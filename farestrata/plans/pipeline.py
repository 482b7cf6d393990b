"""The layered job: load new files, build bronze, silver and gold, check every layer before the next."""

from __future__ import annotations

import json
import logging
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import UTC, date, datetime, timedelta
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from farestrata import refs, schemas
from farestrata.config import (
    FAILED,
    LOADED,
    MESSAGE_LIMIT,
    NOT_AVAILABLE,
    SKIPPED,
    TRIPS_DATASET,
    TRIPS_FOLDER,
    ZONES_DATASET,
    ZONES_FILE,
    Calendar,
    Limits,
)
from farestrata.operators import bronze, checks, gold, ledger, marts, silver
from farestrata.operators.dedup import stored_groups
from farestrata.plans import suites
from farestrata.session import tidy
from farestrata.sources import landing
from farestrata.sources.tables import KEEP, FileTable, new_run

PARALLEL = 4
log = logging.getLogger(__name__)

WHOLE_TABLES = (
    "raw.zones", "raw.ledger", "bronze.zones", "silver.zones", "silver.vendors", "silver.rate_codes",
    "silver.payment_types", "gold.dim_date", "gold.dim_time", "gold.dim_zone", "gold.dim_vendor",
    "gold.dim_rate_code", "gold.dim_payment_type",
)
FILE_TABLES = ("raw.trips", "bronze.trips", "silver.standardized", "silver.valid", "gold.fct_trips")


class LayerCheckFailed(RuntimeError):
    """A layer broke its checks; the layers above it were not built."""

    def __init__(self, layer: str, broken: list[Row]):
        found = "; ".join(f"{b.check} {b.table} [{b.column}]: {b.failures}" for b in broken)
        super().__init__(f"{layer}: {found}")
        self.layer, self.broken = layer, broken


class LoadFailed(RuntimeError):
    """Some files could not be loaded; the others were."""


@dataclass(frozen=True)
class FileResult:
    source_file: str
    source_period: object
    status: str
    rows: int
    message: str = ""


@dataclass
class Lake:
    """The stored layers under one root, and the settings they are built with."""

    spark: SparkSession
    root: str
    limits: Limits = Limits()
    calendar: Calendar = Calendar()
    #: folder of CSV code tables to use instead of the built-in ones
    code_tables: str | None = None
    #: rebuilds remove what they superseded longer ago than that; None leaves it to :meth:`compact`
    keep: timedelta | None = None

    def table(self, name: str) -> FileTable:
        layer, table = name.split(".")
        return FileTable(self.spark, f"{self.root}/{layer}/{table}", whole=name in WHOLE_TABLES)

    def read(self, name: str) -> DataFrame:
        views = {
            "silver.rejected": lambda: silver.rejected_trips(self.read("silver.standardized")),
            "silver.quality_summary": lambda: silver.quality_summary(self.read("silver.standardized")),
        }
        return views[name]() if name in views else self.table(name).read()

    def compact(self, keep: timedelta = KEEP) -> dict[str, int]:
        """Remove from every table what was superseded more than ``keep`` ago; folders removed per table."""
        names = [*WHOLE_TABLES, *FILE_TABLES]
        removed = _side_by_side(lambda name: self.table(name).compact(keep), names)
        return dict(zip(names, removed, strict=True))

    def references(self) -> refs.References:
        return refs.References(
            vendors=self.read("silver.vendors"),
            rate_codes=self.read("silver.rate_codes"),
            payment_types=self.read("silver.payment_types"),
            zones=self.read("silver.zones"),
        )

    def star(self) -> marts.Star:
        return marts.Star(
            fact=self.read("gold.fct_trips"),
            date=self.read("gold.dim_date"),
            time=self.read("gold.dim_time"),
            zone=self.read("gold.dim_zone"),
            payment_type=self.read("gold.dim_payment_type"),
        )

    def ledger(self) -> DataFrame:
        """One row per file seen so far.

        The row of a loaded file is committed with its rows, as their note. It counts from then on, also if the run ended
        before it could bring the ledger table up to date.
        """
        if self.table("raw.ledger").current():
            recorded = self.read("raw.ledger")
        else:
            recorded = self.spark.createDataFrame([], schemas.LEDGER)
        loads = [*self.table("raw.trips").current().values(), *self.table("raw.zones").current().values()]
        noted = [_entry(load.note) for load in loads if load.note]
        known = recorded.select("source_file", F.col("updated_at").alias("recorded_at"))
        newer = (
            self.spark.createDataFrame(noted, schemas.LEDGER).join(known, "source_file", "left")
            .where(F.col("recorded_at").isNull() | (F.col("updated_at") > F.col("recorded_at")))
            .drop("recorded_at")
        )
        return ledger.upsert(recorded, newer)

    def record(self, entries: list[dict]) -> None:
        """Bring the ledger table up to date with what was committed, and with ``entries`` on files that weren't."""
        new = self.spark.createDataFrame(
            [{name: entry.get(name) for name in schemas.LEDGER.names} for entry in entries], schemas.LEDGER
        )
        self.table("raw.ledger").replace(ledger.upsert(self.ledger(), new).coalesce(1))


def _note(entry: dict) -> str:
    return json.dumps(entry, default=str)


def _entry(note: str) -> dict:
    """A ledger entry from the note that keeps it."""
    entry = json.loads(note)
    if entry.get("source_period"):
        entry["source_period"] = date.fromisoformat(entry["source_period"])
    entry["updated_at"] = datetime.fromisoformat(entry["updated_at"])
    return {name: entry.get(name) for name in schemas.LEDGER.names}


# --- raw --------------------------------------------------------------------------------------------------


def plan_loads(lake: Lake, source: str, start: str, end: str, force: bool = False) -> DataFrame:
    raw = lake.table("raw.trips")
    if raw.current():
        rows = ledger.row_counts(raw.read())
    else:
        rows = lake.spark.createDataFrame([], "source_file string, raw_rows bigint")
    return ledger.load_plan(
        ledger.expected_files(lake.spark, start, end),
        landing.inventory(lake.spark, source),
        lake.ledger(),
        rows,
        force,
    )


def drift_message(columns: list[str]) -> str:
    """``ok``, and the columns that are missing or unexpected, if any."""
    named: dict[str, list[str]] = {}
    for column, state in bronze.schema_drift(columns):
        named.setdefault(state, []).append(column)
    return "; ".join(["ok", *(f"{state}: {', '.join(sorted(found))}" for state, found in sorted(named.items()))])


def _load_files(lake: Lake, source: str, entries: list[dict], loaded_at: datetime) -> list[dict]:
    """Replace the raw rows of files that have the same columns; the rows written must be the rows of each file.

    The ledger entries, completed here, become current in the same commit as the rows. Names without files give an error.
    """
    names = [entry["source_file"] for entry in entries]
    landed = landing.open_trips(lake.spark, source, *names)
    table, run = lake.table("raw.trips"), new_run()
    keys = [f"{TRIPS_FOLDER}/{name}" for name in names]
    rows = landing.scan_trips(landed, loaded_at)
    table.stage(rows, run, gathered=True)
    staged = table.staged_rows(run, keys, rows.schema)
    expected = landing.rows_per_file(landed)
    message, columns = drift_message(landed.columns), ",".join(landed.columns)
    done = []
    for entry, key in zip(entries, keys, strict=True):
        n = expected.get(entry["source_file"], 0)
        if staged[key] != n:
            raise RuntimeError(f"{staged[key]} rows were written but the file has {n}")
        if message != "ok":
            log.warning("%s: %s", entry["source_file"], message)
        done.append(entry | {
            "status": LOADED, "message": message, "file_rows": n, "rows_loaded": n, "source_columns": columns,
        })
    table.commit(run, staged, rows.schema, notes={key: _note(entry) for key, entry in zip(keys, done, strict=True)})
    return done


def _load_group(lake: Lake, source: str, entries: list[dict], loaded_at: datetime) -> list[dict]:
    """Load files together; if that fails, each half by itself, until the file that fails is alone."""
    try:
        return _load_files(lake, source, entries, loaded_at)
    except Exception as error:
        if len(entries) == 1:
            return [entries[0] | {"status": FAILED, "message": str(error)[:MESSAGE_LIMIT]}]
    half = len(entries) // 2
    return [done for part in (entries[:half], entries[half:]) for done in _load_group(lake, source, part, loaded_at)]


def _side_by_side(function: Callable, items: list) -> list:
    with ThreadPoolExecutor(PARALLEL) as pool:
        return list(pool.map(inheritable_thread_target(function), items))


def load_trips(
    lake: Lake, source: str, start: str, end: str, force: bool = False, fail_on_missing: bool = False
) -> list[FileResult]:
    """Load the files that are new or changed. A file that fails is recorded and the others go on.

    Files with the same columns are loaded by one job and one commit.
    """
    loaded_at = datetime.now(UTC)
    # one row per month of the range
    plan = plan_loads(lake, source, start, end, force).orderBy("source_period").collect()
    published = {row.source_file: row for row in landing.inventory(lake.spark, source).collect()}
    entries = {
        row.source_file: {
            "source_file": row.source_file,
            "dataset": TRIPS_DATASET,
            "source_period": row.source_period,
            "source_url": landing.trips_path(source, row.source_file),
            "updated_at": loaded_at,
        }
        for row in plan if row.action != SKIPPED
    }
    for row in plan:
        if row.action == NOT_AVAILABLE:
            entries[row.source_file] |= {"status": NOT_AVAILABLE, "message": "not published yet"}
        elif row.action == ledger.LOAD:
            entries[row.source_file] |= {
                "etag": row.etag,
                "content_length": row.content_length,
                "source_last_modified": published[row.source_file].source_last_modified,
            }

    def columns_of(name: str) -> tuple | str:
        try:
            return landing.columns_of(lake.spark, source, name)
        except Exception as error:
            return str(error)[:MESSAGE_LIMIT]

    wanted = [row.source_file for row in plan if row.action == ledger.LOAD]
    groups: dict[tuple, list[dict]] = {}
    for name, found in zip(wanted, _side_by_side(columns_of, wanted), strict=True):
        if isinstance(found, str):
            entries[name] |= {"status": FAILED, "message": found}
        else:
            groups.setdefault(found, []).append(entries[name])
    for done in _side_by_side(lambda group: _load_group(lake, source, group, loaded_at), list(groups.values())):
        entries |= {entry["source_file"]: entry for entry in done}
    if entries:
        lake.record([entry for entry in entries.values() if entry["status"] != LOADED])
    results = []
    for row in plan:
        entry = entries.get(row.source_file, {"status": SKIPPED, "rows_loaded": row.rows_kept, "message": ""})
        results.append(
            FileResult(row.source_file, row.source_period, entry["status"], entry.get("rows_loaded") or 0, entry["message"])
        )
    summary = summarize(lake.spark, results).first()
    unmet = {FAILED: summary.months_failed, NOT_AVAILABLE: summary.months_not_available if fail_on_missing else 0}
    if any(unmet.values()):
        named = [f"{r.source_file} ({r.status}: {r.message})" for r in results if unmet.get(r.status)]
        raise LoadFailed(f"{len(named)} files are not loaded: {'; '.join(named)}")
    return results


def summarize(spark: SparkSession, results: list[FileResult]) -> DataFrame:
    rows = [(r.source_period, r.status, r.rows) for r in results]
    return ledger.load_summary(spark.createDataFrame(rows, "source_period date, status string, rows bigint"))


def load_zones(lake: Lake, source: str) -> int:
    """Replace the zone lookup; the rows written must be the rows of the file."""
    loaded_at = datetime.now(UTC)
    rows = landing.scan_zones(lake.spark, source, loaded_at)
    table, run = lake.table("raw.zones"), new_run()
    table.stage(rows.coalesce(1), run)
    staged = table.staged_rows(run, ["*"], rows.schema)
    expected = rows.count()
    if staged["*"] != expected:
        raise RuntimeError(f"{staged['*']} zones were written but the file has {expected}")
    published = landing.zones_inventory(lake.spark, source).first()
    entry = {
        "source_file": ZONES_FILE,
        "dataset": ZONES_DATASET,
        "source_url": landing.zones_path(source),
        "etag": published.etag,
        "content_length": published.content_length,
        "source_last_modified": published.source_last_modified,
        "file_rows": expected,
        "rows_loaded": expected,
        "source_columns": ",".join(schemas.ZONE_FILE.names),
        "status": LOADED,
        "message": "ok",
        "updated_at": loaded_at,
    }
    table.commit(run, staged, rows.schema, notes={"*": _note(entry)})
    lake.record([])
    return expected


# --- bronze, silver, gold ---------------------------------------------------------------------------------


def build_changed(
    lake: Lake, target: str, upstream: str, build: Callable[[DataFrame], DataFrame], full_refresh: bool = False
) -> list[str]:
    """Rebuild, in ``target``, the files whose load in ``upstream`` is not the one they were built from.

    ``build`` leaves the rows in the tasks that read them, which hold few files each.
    """
    source, sink = lake.table(upstream), lake.table(target)
    arrived, built = source.current(), sink.current()
    changed = [
        f for f, load in arrived.items()
        if full_refresh or f not in built or built[f].built_from != load.load_id
    ]
    if changed:
        built_from = {f: arrived[f].load_id for f in changed}
        sink.replace(build(source.read(changed)), changed, built_from, gathered=True)
        if lake.keep is not None:
            sink.compact(lake.keep)
    return changed


def rebuild(lake: Lake, **tables: DataFrame) -> None:
    """Replace small tables, given as ``layer__table``, a few at a time."""
    def one(item: tuple[str, DataFrame]) -> None:
        lake.table(item[0].replace("__", ".")).replace(item[1].coalesce(1))

    _side_by_side(one, list(tables.items()))


def judged_trips(lake: Lake, bronze_trips: DataFrame) -> DataFrame:
    """Standardised and judged records. Bronze rows are stored by file and stay so, but for copies; a pass over their keys alone is cheap."""
    return silver.standardized_trips(
        bronze_trips, lake.references(), lake.limits, keep=stored_groups, gather="_source_file"
    )


def build_bronze(lake: Lake, full_refresh: bool = False) -> None:
    rebuild(lake, bronze__zones=bronze.bronze_zones(lake.read("raw.zones")))
    build_changed(lake, "bronze.trips", "raw.trips", bronze.bronze_trips, full_refresh)


def build_silver(lake: Lake, full_refresh: bool = False) -> None:
    rebuild(
        lake,
        silver__zones=silver.clean_zones(lake.read("bronze.zones")),
        **{f"silver__{name}": table for name, table in refs.code_tables(lake.spark, lake.code_tables).items()},
    )
    build_changed(lake, "silver.standardized", "bronze.trips", lambda b: judged_trips(lake, b), full_refresh)
    build_changed(lake, "silver.valid", "silver.standardized", silver.valid_trips, full_refresh)


def build_gold(lake: Lake, full_refresh: bool = False) -> None:
    rebuild(
        lake,
        gold__dim_date=gold.dim_date(lake.spark, lake.calendar),
        gold__dim_time=gold.dim_time(lake.spark),
        gold__dim_zone=gold.dim_zone(lake.read("silver.zones")),
        gold__dim_vendor=gold.dim_vendor(lake.read("silver.vendors")),
        gold__dim_rate_code=gold.dim_rate_code(lake.read("silver.rate_codes")),
        gold__dim_payment_type=gold.dim_payment_type(lake.read("silver.payment_types")),
    )
    build_changed(lake, "gold.fct_trips", "silver.valid", gold.fct_trips, full_refresh)


# --- checks -----------------------------------------------------------------------------------------------


def reconciliations(lake: Lake, layer: str) -> dict[str, DataFrame]:
    """Checks between tables, each returning the rows that break it."""
    if layer == "raw":
        return {"raw matches ledger": checks.ledger_mismatches(lake.read("raw.trips"), lake.ledger(), TRIPS_DATASET)}
    if layer == "bronze":
        return {"bronze matches raw": checks.count_mismatches(
            lake.read("raw.trips"), lake.read("bronze.trips"), "raw_rows", "bronze_rows"
        )}
    if layer == "silver":
        judged, valid = lake.read("silver.standardized"), lake.read("silver.valid")
        return {
            "silver keeps every record": checks.count_mismatches(
                lake.read("bronze.trips"), judged, "bronze_rows", "silver_rows"
            ),
            "valid holds what was judged valid": checks.validity_mismatches(judged, valid),
            "no repeated trips": checks.repeated_business_keys(valid, silver.BUSINESS_KEY, stored=True),
        }
    fact = lake.read("gold.fct_trips")
    return {
        "fact matches valid trips": checks.amount_mismatches(lake.read("silver.valid"), fact),
        "every loaded file reaches the fact": checks.files_missing_from(fact, lake.ledger(), TRIPS_DATASET),
    }


def check_layer(lake: Lake, layer: str) -> DataFrame:
    """All results of a layer: ``check, table, column, failures``."""
    declared = []
    for spec in suites.LAYERS[layer]:
        df = lake.ledger() if spec.table == "raw.ledger" else lake.read(spec.table)
        parents = {r.table: lake.read(r.table) for r in spec.relationships}
        declared.append(checks.run_checks(df, spec, parents, stored=spec.table in FILE_TABLES))
    between = [
        rows.agg(F.count("*").alias("failures")).select(
            F.lit("reconciliation").alias("check"), F.lit(layer).alias("table"), F.lit(name).alias("column"),
            "failures",
        )
        for name, rows in reconciliations(lake, layer).items()
    ]
    return reduce(DataFrame.union, declared + between)


def gate(lake: Lake, layer: str) -> None:
    with tidy(lake.spark):
        broken = check_layer(lake, layer).where("failures > 0").collect()
    if broken:
        raise LayerCheckFailed(layer, broken)


BUILDERS = {"bronze": build_bronze, "silver": build_silver, "gold": build_gold}


def run_layers(lake: Lake, full_refresh: bool = False) -> None:
    """Build and check one layer after the other; stop at the first that fails its checks."""
    gate(lake, "raw")
    for layer, build in BUILDERS.items():
        build(lake, full_refresh)
        gate(lake, layer)


def run(
    lake: Lake,
    source: str,
    start: str,
    end: str,
    force: bool = False,
    full_refresh: bool = False,
    fail_on_missing: bool = False,
) -> list[FileResult]:
    load_zones(lake, source)
    results = load_trips(lake, source, start, end, force, fail_on_missing)
    run_layers(lake, full_refresh)
    return results
