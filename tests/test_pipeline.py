"""The whole job on a small landing folder."""

from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from farestrata.config import TRIP_COLUMNS
from farestrata.operators import marts
from farestrata.plans import pipeline
from farestrata.streaming import arrivals
from trips import GOOD


def land(folder, month, trips):
    """Write one monthly file; every trip starts in its month."""
    rows = []
    for n, change in enumerate(trips):
        start = datetime(2025, month, 10, 8) + timedelta(minutes=n)
        rows.append({**GOOD, "tpep_pickup_datetime": start, "tpep_dropoff_datetime": start + timedelta(minutes=30), **change})
    path = folder / f"yellow/yellow_tripdata_2025-{month:02d}.parquet"
    pq.write_table(pa.table({c: [r[c] for r in rows] for c in TRIP_COLUMNS}), path)
    return path


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "yellow").mkdir()
    (tmp_path / "zones").mkdir()
    (tmp_path / "zones/taxi_zone_lookup.csv").write_text(
        "LocationID,Borough,Zone,service_zone\n"
        "1,EWR,Newark Airport,EWR\n2,Queens,Jamaica Bay,Boro Zone\n264,Unknown,N/A,N/A\n265,N/A,Outside of NYC,N/A\n"
    )
    return tmp_path


def per_file(lake, table):
    return {r[0][23:30]: r[1] for r in lake.read(table).groupBy("_source_file").count().collect()}


def test_load_reload_and_failures(spark, folder, tmp_path):
    lake = pipeline.Lake(spark, f"{tmp_path}/lake")
    source = str(folder)
    again = {"tpep_pickup_datetime": datetime(2025, 1, 10, 8), "tpep_dropoff_datetime": datetime(2025, 1, 10, 8, 30)}
    land(folder, 1, [{}, {}, again, {"tip_amount": -1.0}])
    land(folder, 2, [{}, {}])

    # first run
    results = pipeline.run(lake, source, "2025-01", "2025-03")
    assert [r.status for r in results] == ["LOADED", "LOADED", "NOT_AVAILABLE"]
    assert tuple(pipeline.summarize(spark, results).first()) == (2, 0, 1, 0, "2025-03", 6)
    assert per_file(lake, "silver.standardized") == {"2025-01": 4, "2025-02": 2}
    assert per_file(lake, "gold.fct_trips") == {"2025-01": 2, "2025-02": 2}
    reasons = {r.rejection_reason for r in lake.read("silver.rejected").collect()}
    assert reasons == {"DUPLICATE", "NEGATIVE_AMOUNT"}
    assert [r.viajes for r in marts.monthly_revenue(lake.star()).collect()] == [2, 2]
    loads = {t: lake.table(t).current() for t in pipeline.FILE_TABLES}

    # nothing changed: nothing is loaded or rebuilt
    results = pipeline.load_trips(lake, source, "2025-01", "2025-02")
    assert [(r.status, r.rows) for r in results] == [("SKIPPED", 4), ("SKIPPED", 2)]
    for upstream, target in zip(pipeline.FILE_TABLES, pipeline.FILE_TABLES[1:], strict=False):
        assert pipeline.build_changed(lake, target, upstream, lambda df: df) == []
    assert {t: lake.table(t).current() for t in pipeline.FILE_TABLES} == loads

    # a reload whose rows are all rejected leaves nothing behind; a broken file is recorded and harms no other
    land(folder, 1, [{"tip_amount": -1.0}] * 3)
    (folder / "yellow/yellow_tripdata_2025-03.parquet").write_bytes(b"not parquet")
    land(folder, 4, [{}])
    with pytest.raises(pipeline.LoadFailed, match="2025-03"):
        pipeline.load_trips(lake, source, "2025-01", "2025-04")
    pipeline.build_bronze(lake)
    pipeline.build_silver(lake)
    pipeline.build_gold(lake)
    assert per_file(lake, "silver.standardized") == {"2025-01": 3, "2025-02": 2, "2025-04": 1}
    assert per_file(lake, "gold.fct_trips") == {"2025-02": 2, "2025-04": 1}
    unreached = pipeline.reconciliations(lake, "gold")["every loaded file reaches the fact"]
    assert [r[0][-15:-8] for r in unreached.collect()] == ["2025-01"]
    states = {r.source_file[-15:-8]: (r.status, r.attempts) for r in lake.ledger().where("source_period is not null").collect()}
    assert states == {
        "2025-01": ("LOADED", 2), "2025-02": ("LOADED", 1), "2025-03": ("FAILED", 2), "2025-04": ("LOADED", 1)
    }


def test_gate_stops_at_the_broken_layer(spark, folder, tmp_path):
    lake = pipeline.Lake(spark, f"{tmp_path}/lake")
    land(folder, 1, [{"trip_distance": None}])
    # a trip without distance breaks no rule but fails a check of the valid table
    with pytest.raises(pipeline.LayerCheckFailed, match="trip_distance_miles"):
        pipeline.run(lake, str(folder), "2025-01", "2025-01")
    assert lake.table("silver.valid").current() and not lake.table("gold.fct_trips").current()


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_a_hot_group_of_copies_by_either_join(spark, folder, tmp_path, broadcast):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    lake = pipeline.Lake(spark, f"{tmp_path}/lake")
    same = {"tpep_pickup_datetime": datetime(2025, 1, 2), "tpep_dropoff_datetime": datetime(2025, 1, 3)}
    land(folder, 1, [same] * 5 + [{}])
    pipeline.load_zones(lake, str(folder))
    pipeline.load_trips(lake, str(folder), "2025-01", "2025-01")
    pipeline.build_bronze(lake)
    pipeline.build_silver(lake)
    assert lake.read("silver.valid").count() == 2
    kept = lake.read("silver.standardized").where("not dq_duplicate").agg(F.min("_file_row_number")).first()[0]
    assert kept == 1
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_arriving_files_run_the_job(spark, folder, tmp_path, monkeypatch):
    runs = []
    monkeypatch.setattr(pipeline, "run", lambda lake, source, start, end: runs.append((start, end)))
    lake = pipeline.Lake(spark, f"{tmp_path}/lake")
    for month in (1, 2):
        land(folder, month, [{}])
        arrivals.follow(lake, str(folder), f"{tmp_path}/seen").awaitTermination()
    arrivals.follow(lake, str(folder), f"{tmp_path}/seen").awaitTermination()
    assert runs == [("2025-01", "2025-01"), ("2025-02", "2025-02")]


def test_a_run_that_ends_between_two_files_keeps_the_first(spark, folder, tmp_path, monkeypatch):
    lake = pipeline.Lake(spark, f"{tmp_path}/lake")
    path = land(folder, 1, [{}, {}])
    landed = pq.read_table(path)
    pq.write_table(landed.drop_columns(["airport_fee"]).append_column("new_one", landed["extra"]), path)
    land(folder, 2, [{}])
    opened = pipeline.landing.open_trips

    def stop_at_february(spark, source, file_name):
        if "-02" in file_name:
            raise KeyboardInterrupt
        return opened(spark, source, file_name)

    with monkeypatch.context() as broken, pytest.raises(KeyboardInterrupt):
        broken.setattr(pipeline.landing, "open_trips", stop_at_february)
        pipeline.load_trips(lake, str(folder), "2025-01", "2025-02")
    assert not lake.table("raw.ledger").current()
    assert lake.ledger().first().message == "ok; missing: airport_fee; unexpected: new_one"

    results = pipeline.load_trips(lake, str(folder), "2025-01", "2025-02")
    assert [(r.status, r.rows) for r in results] == [("SKIPPED", 2), ("LOADED", 1)]
    pipeline.load_zones(lake, str(folder))
    entries = {r.source_file[-11:]: r for r in lake.ledger().collect()}
    assert {name: r.attempts for name, r in entries.items()} == {"-01.parquet": 1, "-02.parquet": 1, "_lookup.csv": 1}
    zone = entries["_lookup.csv"]
    assert zone.source_url.endswith("zones/taxi_zone_lookup.csv") and zone.etag and zone.source_last_modified
    assert zone.content_length == (folder / "zones/taxi_zone_lookup.csv").stat().st_size


def test_code_tables_of_the_user(spark, folder, tmp_path, monkeypatch):
    for name, text in {
        "ref_vendor": "vendor_id,vendor_name\n1,One\n-1,Unknown\n",
        "ref_rate_code": "rate_code_id,rate_code_name,rate_code_description_es\n1,Standard,Normal\n99,Unknown,Desconocido\n",
        "ref_payment_type": "payment_type_id,payment_type_name,payment_type_description_es\n5,Unknown,Desconocido\n",
    }.items():
        (tmp_path / f"{name}.csv").write_text(text)
    lake = pipeline.Lake(spark, f"{tmp_path}/lake", code_tables=str(tmp_path))
    pipeline.load_zones(lake, str(folder))
    monkeypatch.setattr(pipeline, "build_changed", lambda *_: [])
    pipeline.build_bronze(lake)
    pipeline.build_silver(lake)
    assert sorted(map(tuple, lake.read("silver.vendors").collect())) == [(-1, "Unknown"), (1, "One")]
    assert lake.references().rate_codes.count() == 2 and lake.references().payment_types.count() == 1


def test_a_group_that_fails_is_halved(spark, folder, tmp_path, monkeypatch):
    """Files with the same columns are one job; one that fails is found and the others are loaded."""
    lake = pipeline.Lake(spark, f"{tmp_path}/lake")
    for month in (1, 2, 3, 4):
        land(folder, month, [{}] * month)
    sizes, load = [], pipeline._load_files

    def breaks_on_march(lake, source, entries, loaded_at):
        sizes.append(len(entries))
        if any("-03" in entry["source_file"] for entry in entries):
            raise ValueError("March can't be read")
        return load(lake, source, entries, loaded_at)

    monkeypatch.setattr(pipeline, "_load_files", breaks_on_march)
    with pytest.raises(pipeline.LoadFailed, match="2025-03.parquet .FAILED: March"):
        pipeline.load_trips(lake, str(folder), "2025-01", "2025-04")
    assert sizes == [4, 2, 2, 1, 1]
    assert per_file(lake, "raw.trips") == {"2025-01": 1, "2025-02": 2, "2025-04": 4}
    states = {r.source_file[-10:-8]: (r.status, r.rows_loaded) for r in lake.ledger().collect()}
    assert states == {"01": ("LOADED", 1), "02": ("LOADED", 2), "03": ("FAILED", None), "04": ("LOADED", 4)}


def test_marking_copies_runs_no_job_before_it_is_asked(spark):
    from farestrata.operators import dedup

    frame = spark.createDataFrame([(1, 1), (1, 2), (None, 3), (None, 4), (2, 5)], "k int, position int")
    spark.sparkContext.setJobGroup("marking", "")
    try:
        marked = dedup.mark_later_copies(frame, ["k"], "position", "later")
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("marking")
        assert sorted(r.position for r in marked.where("later").collect()) == [2, 4]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
