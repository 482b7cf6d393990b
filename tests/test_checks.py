import pytest
from pyspark.sql import functions as F

from farestrata.operators import checks
from farestrata.operators.checks import Relationship, TableChecks
from farestrata.plans import suites

LEDGER = "source_file string, dataset string, status string, rows_loaded bigint"


def failures(df):
    return {(r.check, r.column): r.failures for r in df.collect()}


def test_declared_suites_hold_the_expected_number_of_checks():
    specs = [spec for layer in suites.LAYERS.values() for spec in layer]
    kinds = {
        "not_null": 65, "unique": 24, "relationships": 14, "accepted_values": 3, "accepted_range": 2, "expressions": 2
    }
    assert {k: sum(len(getattr(s, k)) for s in specs) for k in kinds} == kinds
    assert sum(s.count() for s in specs) == 110


def test_row_checks_pass_nulls_except_not_null(spark):
    df = spark.sql("select * from values (1, 'a'), (7, 'b'), (null, null) t(n, s)")
    spec = TableChecks(
        "t", not_null=("n",), accepted_values={"s": ["a"]}, accepted_range={"n": (1, 6)}, expressions=("n < 5",)
    )
    assert failures(checks.run_checks(df, spec)) == {
        ("not_null", "n"): 1, ("accepted_values", "s"): 1, ("accepted_range", "n"): 1,
        ("expression_is_true", "n < 5"): 1,
    }


def test_unique_ignores_nulls_and_counts_values(spark):
    df = spark.sql("select * from values (1), (1), (1), (2), (null), (null) t(n)")
    assert failures(checks.run_checks(df, TableChecks("t", unique=("n",)))) == {("unique", "n"): 1}


def test_relationships_count_rows(spark):
    child = spark.sql("select * from values (1), (3), (3), (null) t(n)")
    parent = spark.sql("select * from values (1), (2) t(k)")
    spec = TableChecks("t", relationships=(Relationship("n", "p", "k"),))
    assert failures(checks.run_checks(child, spec, {"p": parent})) == {("relationships", "n"): 2}


def test_keys_are_compared_in_the_wider_type(spark):
    child = spark.sql("select * from values (1.0D, 'a', 1), (1.5D, 'b', 2), (null, null, null) t(d, s, n)")
    numbers, letters = spark.sql("select 1 as k"), spark.sql("select 'a' as k")
    spec = TableChecks("t", relationships=(
        Relationship("d", "numbers", "k"), Relationship("s", "letters", "k"), Relationship("n", "numbers", "k")
    ))
    found = checks.relationship_checks(child, spec, {"numbers": numbers, "letters": letters})
    assert failures(found) == {("relationships", "d"): 1, ("relationships", "s"): 1, ("relationships", "n"): 1}


def test_one_column_with_two_parents(spark):
    child = spark.sql("select * from values (1), (2), (2) t(n)")
    spec = TableChecks("t", relationships=(Relationship("n", "a", "k"), Relationship("n", "b", "k")))
    found = checks.relationship_checks(child, spec, {"a": spark.sql("select 1 as k"), "b": spark.sql("select 2L as k")})
    assert sorted(r.failures for r in found.collect()) == [1, 2]


def test_unique_compares_values_not_their_text(spark):
    df = spark.sql("select * from values (0.0D, 1), (-0.0D, 2) t(d, n)")
    assert failures(checks.unique_checks(df, TableChecks("t", unique=("d", "n")))) == {
        ("unique", "d"): 1, ("unique", "n"): 0
    }


def test_checks_hold_on_empty_tables(spark):
    empty = spark.createDataFrame([], "n int")
    spec = TableChecks("t", not_null=("n",), unique=("n",), relationships=(Relationship("n", "p", "n"),))
    assert set(failures(checks.run_checks(empty, spec, {"p": empty})).values()) == {0}


@pytest.fixture
def rows(spark):
    return spark.sql("""
        select * from values ('y/a.parquet', 1, 5.0BD), ('y/a.parquet', 1, 6.0BD), ('y/b.parquet', 1, 7.0BD)
        t(_source_file, trip_count, total_amount)""")


def test_count_and_amount_mismatches(rows):
    assert checks.count_mismatches(rows, rows, "l", "r").count() == 0
    fewer = rows.where("total_amount <> 5")
    assert [tuple(r) for r in checks.count_mismatches(rows, fewer, "l", "r").collect()] == [("y/a.parquet", 2, 1)]
    gone = rows.where("_source_file <> 'y/b.parquet'")
    assert [tuple(r) for r in checks.count_mismatches(gone, rows, "l", "r").collect()] == [("y/b.parquet", None, 1)]
    assert checks.amount_mismatches(rows, rows).count() == 0
    dearer = rows.withColumn("total_amount", F.col("total_amount") + 1)
    assert checks.amount_mismatches(rows, dearer).count() == 2


def test_ledger_checks(spark, rows):
    ledger = spark.createDataFrame([
        ("a.parquet", "d", "LOADED", 2),
        ("b.parquet", "d", "LOADED", 9),
        ("c.parquet", "d", "LOADED", 1),
        ("e.parquet", "d", "LOADED", None),
        ("f.parquet", "d", "FAILED", 4),
        ("g.parquet", "other", "LOADED", 4),
    ], LEDGER)
    got = {tuple(r) for r in checks.ledger_mismatches(rows, ledger, "d").collect()}
    assert got == {("b.parquet", 9, 1), ("c.parquet", 1, None)}
    assert {r[0] for r in checks.files_missing_from(rows, ledger, "d").collect()} == {"c.parquet", "e.parquet"}


def test_repeated_keys(spark):
    df = spark.sql("select * from values (1, 2), (1, 2), (1, 3) t(a, b)")
    assert [tuple(r) for r in checks.repeated_business_keys(df, ["a", "b"]).collect()] == [(1, 2, 2)]
