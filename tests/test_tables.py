import time
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from farestrata.operators import bronze
from farestrata.sources.files import Files
from farestrata.sources.tables import LOADS, FileTable, new_run

A, B = "yellow/yellow_tripdata_2025-01.parquet", "yellow/yellow_tripdata_2025-02.parquet"


def rows(spark, *pairs):
    return spark.createDataFrame(pairs, "_source_file string, n int")


def held(table):
    return sorted((r._source_file[23:30], r.n) for r in table.read().collect())


def test_replace_by_file(spark, tmp_path):
    table = FileTable(spark, f"{tmp_path}/t")
    with pytest.raises(LookupError):
        table.read()
    assert table.replace(rows(spark, (A, 1), (A, 2), (B, 3)), [A, B]) == {A: 2, B: 1}
    table.replace(rows(spark, (A, 9)), [A])
    assert held(table) == [("2025-01", 9), ("2025-02", 3)]
    assert table.read([B]).count() == 1


def test_a_file_without_rows_becomes_empty(spark, tmp_path):
    table = FileTable(spark, f"{tmp_path}/t")
    table.replace(rows(spark, (A, 1), (B, 3)), [A, B])
    table.replace(rows(spark, (A, 1)).where("false"), [A])
    assert held(table) == [("2025-02", 3)]
    table.replace(rows(spark, (B, 1)).where("false"), [B])
    assert table.read().count() == 0 and table.read().columns == ["_source_file", "n"]


def test_rows_that_were_only_staged_are_not_seen(spark, tmp_path):
    table = FileTable(spark, f"{tmp_path}/t")
    table.replace(rows(spark, (A, 1)), [A])
    run = new_run()
    table.stage(rows(spark, (A, 5), (A, 6)), run)
    assert table.staged_rows(run, [A, B], table.read().schema) == {A: 2, B: 0}
    assert held(table) == [("2025-01", 1)]


def test_a_failing_write_leaves_the_table_alone(spark, tmp_path):
    table = FileTable(spark, f"{tmp_path}/t")
    table.replace(rows(spark, (A, 1)), [A])
    bad = rows(spark, (A, 0)).withColumn("n", F.expr("cast(1 / n as int)"))
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        table.replace(bad, [A])
    assert held(table) == [("2025-01", 1)]


def test_new_columns_are_appended(spark, tmp_path):
    table = FileTable(spark, f"{tmp_path}/t")
    table.replace(rows(spark, (A, 1)), [A])
    table.replace(rows(spark, (B, 2)).withColumn("fee", F.lit(0.5)), [B])
    got = {r._source_file: r.fee for r in table.read().collect()}
    assert got == {A: None, B: 0.5}


def test_whole_tables(spark, tmp_path):
    table = FileTable(spark, f"{tmp_path}/t", whole=True)
    table.replace(spark.range(3))
    table.replace(spark.range(2))
    assert table.read().count() == 2


def test_append_new_columns_in_memory(spark):
    both = bronze.append_new_columns(rows(spark, (A, 1)), rows(spark, (B, 2)).withColumn("fee", F.lit(0.5)))
    assert both.columns == ["_source_file", "n", "fee"] and both.where("fee is null").count() == 1


def test_type_of_a_column_is_widened_whatever_the_order_of_loads(spark, tmp_path):
    for i, (first, second) in enumerate([("1", "2L"), ("1L", "2"), ("cast(1 as float)", "2.0D"), ("1", "2.0D")]):
        table = FileTable(spark, f"{tmp_path}/{i}")
        table.replace(spark.sql(f"select {first} as n, 'a.parquet' as _source_file"), ["a.parquet"])
        table.replace(spark.sql(f"select {second} as n, 'b' as extra, 'b.parquet' as _source_file"), ["b.parquet"])
        read = table.read()
        assert read.columns == ["n", "_source_file", "extra"]
        assert sorted(r.n for r in read.collect()) == [1, 2]


def test_types_that_cannot_be_widened_are_refused(spark, tmp_path):
    table = FileTable(spark, str(tmp_path))
    table.replace(spark.sql("select 1L as n, 'a.parquet' as _source_file"), ["a.parquet"])
    table.replace(spark.sql("select 2.5D as n, 'b.parquet' as _source_file"), ["b.parquet"])
    with pytest.raises(TypeError, match="column n"):
        table.read()


def listed(table):
    return table.spark.read.schema(LOADS).option("recursiveFileLookup", True).parquet(table.loads)


def folders(table):
    files = Files(table.spark, table.data)
    return sorted((run, part) for run in files.names_in(table.data) for part in files.names_in(f"{table.data}/{run}") if part[0] == "_")


def test_compacting_keeps_what_is_current_and_what_is_young(spark, tmp_path):
    table = FileTable(spark, f"{tmp_path}/t")
    assert table.compact() == 0
    table.replace(rows(spark, (A, 1), (B, 2)), [A, B])
    before = table.read()
    table.replace(rows(spark, (A, 3)), [A])
    table.stage(rows(spark, (B, 8)), new_run())
    assert table.compact() == 0 and len(Files(spark, table.loads).names_in(table.loads)) == 1
    # the list is short, but what was superseded lately is still listed and readable
    assert listed(table).count() == 3 and before.count() == 2 and held(table) == [("2025-01", 3), ("2025-02", 2)]
    time.sleep(0.01)
    assert table.compact(timedelta(0)) == 2
    assert listed(table).count() == 2 and held(table) == [("2025-01", 3), ("2025-02", 2)]
    assert len([f for f in folders(table) if f[1].startswith("_part=")]) == 2
    assert table.compact(timedelta(0)) == 0
    table.replace(rows(spark, (A, 4)), [A])
    assert held(table) == [("2025-01", 4), ("2025-02", 2)]


def test_compacting_again_after_it_ended_half_way(spark, tmp_path, monkeypatch):
    table = FileTable(spark, f"{tmp_path}/t", whole=True)
    for n in range(3):
        table.replace(spark.range(n + 1))

    def stop(self, path):
        raise OSError("gone")

    with monkeypatch.context() as broken, pytest.raises(OSError, match="gone"):
        broken.setattr(Files, "remove_one", stop)
        table.compact(timedelta(0))
    assert table.read().count() == 3 and listed(table).count() == 4
    assert table.compact(timedelta(0)) == 2
    assert table.read().count() == 3 and listed(table).count() == 1


def test_folders_of_others_stay(spark, tmp_path):
    table = FileTable(spark, f"{tmp_path}/t")
    table.replace(rows(spark, (A, 1)), [A])
    (tmp_path / "t/data/notes").mkdir()
    table.compact(timedelta(0))
    assert "notes" in Files(spark, table.data).names_in(table.data) and held(table) == [("2025-01", 1)]
