"""How many bytes the steps move and write, and that they give what the plain ones give."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from farestrata.operators import checks, dedup
from farestrata.operators.checks import TableChecks
from farestrata.plans import bridge, landed
from farestrata.plans.catalog import Inputs
from farestrata.sources.tables import FileTable

A, B = "yellow/yellow_tripdata_2025-01.parquet", "yellow/yellow_tripdata_2025-02.parquet"
PAIRS = [
    (None, 1, 1), (1, None, 2), (None, 1, 3), (1, None, 4), (1, 1, 5), (1, 1, None), (1, 1, 7), (None, None, 8), (None, None, 9),
    (2, 2, 10), (0, 1, 11), (1, 0, 12),
]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("most", [4_000_000, 0])
def test_copies_by_stored_fingerprints(spark, monkeypatch, most):
    """NULLs in other places are other keys; a long list of groups is joined by shuffle."""
    monkeypatch.setattr(dedup, "MOST_BROADCAST_GROUPS", most)
    frame = spark.createDataFrame(PAIRS, "a int, b int, position int")
    plain = dedup.mark_later_copies(frame, ["a", "b"], "position", "later")
    kept = dedup.mark_later_copies(frame, ["a", "b"], "position", "later", dedup.stored_groups, "a")
    assert kept.columns == plain.columns
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, plain.collect()))
    assert {r.position for r in kept.where("later").collect()} == {3, 4, 7, 9}


def test_stored_groups_leave_wide_rows_where_they_are(spark, tmp_path):
    """Also with a list that Spark would not broadcast by itself."""
    spark.range(4000).selectExpr("id % 1500 as k", "id as position", "repeat('x', 50) as wide").write.parquet(f"{tmp_path}/t")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        marked = dedup.mark_later_copies(spark.read.parquet(f"{tmp_path}/t"), ["k"], "position", "later", dedup.stored_groups)
        assert "hashpartitioning" not in plan_of(marked)
        assert marked.where("later").count() == 2500
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_stored_rows_are_written_where_they_are_read(spark, tmp_path):
    """One file per folder and task that read it, no shuffle, and the setting of the session stays."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    source, sink = FileTable(spark, f"{tmp_path}/a"), FileTable(spark, f"{tmp_path}/b")
    frame = spark.range(100).select(F.when(F.col("id") < 40, A).otherwise(B).alias("_source_file"), F.col("id").alias("n"))
    source.replace(frame)
    spark.sparkContext.setJobGroup("gathered", "")
    try:
        assert sink.replace(source.read(), [A, B], gathered=True) == {A: 40, B: 60}
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert spark.conf.get(name) == before
    assert sorted(map(tuple, sink.read().collect())) == sorted(map(tuple, frame.collect()))
    assert all("zstd" in f.name for f in Path(tmp_path).glob("*/data/*/*/*.parquet"))


def test_unique_by_hashes(spark):
    frame = spark.createDataFrame(
        [("a", 1), ("a", 1), ("b", None), (None, 2), (None, 3), ("c", 3), ("d", None)], "s string, n int"
    )
    spec = TableChecks("t", unique=("s", "n"))
    plain = checks.unique_checks(frame, spec).collect()
    assert checks.unique_checks(frame, spec, stored=True).collect() == plain
    assert [r.failures for r in plain] == [1, 2]
    keys = spark.createDataFrame([(1, None), (1, None), (None, 1), (2, 2)], "a int, b int")
    assert [tuple(r) for r in checks.repeated_business_keys(keys, ["a", "b"], stored=True).collect()] == [(1, None, 2)]
    many = spark.range(3000).selectExpr("id as k")
    assert dedup.suspects(many, ["k"]).count() == 0
    assert dedup.suspects(many.union(many.where("k < 5")), ["k"]).count() == 10


@pytest.mark.parametrize("name", ["landed_inventory", "arrived_files", "load_outcomes"])
def test_trips_are_derived_once(spark, monkeypatch, name):
    """Whatever is published more than once comes from stored rows."""
    read = []

    def publish(trips, folder):
        read.append(trips)
        if len(read) == 2 or name == "load_outcomes":
            raise InterruptedError

    monkeypatch.setattr(landed, "publish", publish)
    monkeypatch.setattr(landed.arrivals, "follow", lambda *_, **__: spark.sparkContext)
    monkeypatch.setattr(spark.sparkContext.__class__, "awaitTermination", lambda _: None, raising=False)
    monkeypatch.setattr(landed, "_kept", lambda listed: listed)
    monkeypatch.setattr(landed.landing, "inventory", lambda *_: None)
    with pytest.raises(InterruptedError):
        getattr(landed, name)(Inputs(spark, "/root/testdata/sf0.001"))
    assert read and all("lineitem" not in plan_of(trips) for trips in read)


def test_judged_trips_move_by_no_key(spark):
    """Once derived, the rows are read again; no copy is found by moving wide rows."""
    data = Inputs(spark, "/root/testdata/sf0.001")
    assert "hashpartitioning" not in plan_of(data.judged)
    assert data.judged.count() == bridge.raw_trips(spark, data.sf_dir).count()
