"""What stays on disk, and which rows move, while the layers are stored."""

from datetime import timedelta
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from farestrata import session
from farestrata.operators import bronze, dedup
from farestrata.plans import catalog, landed, pipeline, suites
from farestrata.sources.tables import FileTable
from trips import distinct, raw

A, B = "yellow/yellow_tripdata_2025-01.parquet", "yellow/yellow_tripdata_2025-02.parquet"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {name for name in names if name.startswith("shuffle_")}


def rows_moved(df, column):
    """Rows that the exchanges of a plan that has run wrote, of those that carry the column."""
    def within(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return within(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return within(node.plan())
        carried = name == "ShuffleExchangeExec" and column in node.output().mkString(",")
        own = node.metrics().apply("shuffleRecordsWritten").value() if carried else 0
        return own + sum(within(node.children().apply(i)) for i in range(node.children().size()))

    df.collect()
    return within(df._jdf.queryExecution().executedPlan())


@pytest.mark.parametrize("gather", [None, "file"])
def test_few_rows_move_where_the_groups_are_too_many_to_broadcast(spark, tmp_path, monkeypatch, gather):
    monkeypatch.setattr(dedup, "MOST_BROADCAST_GROUPS", 0)
    spark.range(4000).union(spark.range(50)).selectExpr(
        "if(id = 7, null, id) as k", "id % 3 as file", "monotonically_increasing_id() as position", "repeat('x', 50) as wide"
    ).write.parquet(f"{tmp_path}/t")
    stored = spark.read.parquet(f"{tmp_path}/t")
    keys = ["k", "file"]
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        marked = dedup.mark_later_copies(stored, keys, "position", "later", dedup.stored_groups, gather)
        # each of 100 copies at most twice, and the few whose bit is that of a group
        assert rows_moved(marked, "wide") < 400
        plain = dedup.mark_later_copies(stored, keys, "position", "later")
        assert marked.columns == plain.columns
        assert sorted(map(repr, marked.collect())) == sorted(map(repr, plain.collect()))
        assert marked.where("later").count() == 50
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_bits_grow_with_the_groups():
    assert [dedup._words_for(n) for n in (1, 4_000_000, 4_400_000, 10**10)] == [2**20, 2**20, 2**21, 2**22]


def test_bits_that_all_rows_share_change_nothing(spark, monkeypatch):
    """With one word, most rows have the bit of a group by chance; they are told by their fingerprints."""
    monkeypatch.setattr(dedup, "MOST_BROADCAST_GROUPS", 0)
    monkeypatch.setattr(dedup, "WORDS", 1)
    frame = spark.range(300).selectExpr("id % 200 as k", "if(id = 3, null, id) as position")
    marked = dedup.mark_later_copies(frame, ["k"], "position", "later", dedup.stored_groups)
    plain = dedup.mark_later_copies(frame, ["k"], "position", "later")
    assert sorted(map(repr, marked.collect())) == sorted(map(repr, plain.collect()))


def test_writes_leave_no_shuffle_files(spark, tmp_path):
    table = FileTable(spark, f"{tmp_path}/t")
    frame = spark.range(1000).select(F.when(F.col("id") < 400, A).otherwise(B).alias("_source_file"), F.col("id").alias("n"))
    before = shuffle_files(spark)
    table.stage(frame, "r")
    assert not shuffle_files(spark) - before
    groups = dedup.stored_groups(dedup.repeated_groups(frame, ["_source_file"], "n"))
    assert not shuffle_files(spark) - before
    assert groups.count() == 2 and spark.conf.get(CLEANUP, "false") == "false"


def test_settings_are_held_and_given_back(spark):
    with session.tidy(spark):
        with session.tidy(spark):
            assert spark.conf.get(CLEANUP) == "true"
        assert spark.conf.get(CLEANUP) == "true"
    assert spark.conf.get(CLEANUP, "false") == "false"
    spark.conf.set(CLEANUP, "true")
    try:
        with session.tidy(spark):
            pass
        assert spark.conf.get(CLEANUP) == "true"
    finally:
        spark.conf.unset(CLEANUP)


@pytest.mark.parametrize(("keep", "runs"), [(None, 3), (timedelta(0), 1), (timedelta(days=7), 3)])
def test_rebuilds_remove_what_they_supersede_if_asked_to(spark, tmp_path, keep, runs):
    lake = pipeline.Lake(spark, str(tmp_path), keep=keep)
    lake.table("raw.trips").replace(raw(spark, *[distinct(n) for n in range(3)]))
    for _ in range(3):
        pipeline.build_changed(lake, "bronze.trips", "raw.trips", bronze.bronze_trips, full_refresh=True)
    assert len(list((tmp_path / "bronze/trips/data").glob("r*/_part=*"))) == runs
    assert lake.read("bronze.trips").count() == lake.read("raw.trips").count() == 3


def test_layers_stored_for_a_query_keep_nothing_superseded(monkeypatch):
    monkeypatch.setattr(catalog, "stored_raw", lambda *_: pipeline.Lake(None, "nowhere"))
    monkeypatch.setattr(catalog, "build_layers", lambda *_: None)
    assert catalog.stored_layers(SimpleNamespace(raw=None)).keep == timedelta(0)


def test_results_of_a_layer_are_stored_before_the_next_is_checked(spark, monkeypatch):
    table = SimpleNamespace(replace=lambda _: None)
    lake = SimpleNamespace(table=lambda _: table, read=lambda _: spark.range(1).selectExpr("id as location_id", "id as time_key"))
    monkeypatch.setattr(landed, "stored_raw", lambda *_: lake)
    monkeypatch.setattr(landed, "build_layers", lambda *_: None)
    monkeypatch.setattr(pipeline, "check_layer", lambda _, layer: spark.range(9).groupBy((F.col("id") % 2).alias(layer)).count())
    results = landed.check_all_layers(SimpleNamespace(raw=None))
    assert results.count() == 2 * len(suites.LAYERS)
    assert "Exchange" not in results._jdf.queryExecution().executedPlan().toString()
