from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from farestrata import functions as fn


def one(spark, column, **values):
    frame = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return frame.select(column.alias("x")).first().x


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_seconds_follow_the_wall_clock(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # the clock change of 2025-03-09 in New York must not shorten the trip
        ends = spark.sql(
            "select timestamp_ntz'2025-03-09 01:30:00' as a, timestamp_ntz'2025-03-09 03:30:00' as b"
        )
        assert ends.select(fn.seconds_between("a", "b")).first()[0] == 7200
        assert ends.select(fn.seconds_between("b", "a")).first()[0] == -7200
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_seconds_count_boundaries(spark):
    ends = spark.sql("select timestamp_ntz'2025-01-01 00:00:00.900' as a, timestamp_ntz'2025-01-01 00:00:01.100' as b")
    assert ends.select(fn.seconds_between("a", "b")).first()[0] == 1
    old = spark.sql("select timestamp_ntz'1969-12-31 23:59:59.900' as a, timestamp_ntz'1970-01-01 00:00:00.100' as b")
    assert old.select(fn.seconds_between("a", "b")).first()[0] == 1


def test_minutes_have_two_exact_decimals(spark):
    ends = spark.sql("select timestamp_ntz'2025-01-01 00:00:00' as a, timestamp_ntz'2025-01-01 00:00:20' as b")
    assert ends.select(fn.minutes_between("a", "b")).first()[0] == Decimal("0.33")


def test_whole_and_money_round_half_up(spark):
    assert one(spark, fn.whole(F.col("v")), v=1.0) == 1
    assert one(spark, fn.whole(F.col("v")), v=2.5) == 3
    assert one(spark, fn.money(F.col("v")), v=1.005) == Decimal("1.01")
    assert one(spark, fn.money(F.col("v")), v=-2.345) == Decimal("-2.35")


def test_ratio_of_nothing_is_null(spark):
    assert one(spark, fn.ratio_percent(F.lit(5), F.lit(0))) is None
    assert one(spark, fn.ratio_percent(F.lit(1).cast("decimal(18,2)"), F.lit(3).cast("decimal(18,2)"))) == Decimal("33.33")


def test_surrogate_key_tells_null_from_text(spark):
    import hashlib

    key = fn.surrogate_key(F.col("a"), F.col("b"))
    frame = spark.sql("select * from values ('x', 1), (null, 1), ('', 1) t(a, b)")
    got = [r[0] for r in frame.select(key).collect()]
    texts = ["x-1", "_dbt_utils_surrogate_key_null_-1", "-1"]
    assert got == [hashlib.md5(t.encode()).hexdigest() for t in texts]


def test_calendar_functions(spark):
    day = F.col("d")
    row = spark.sql("select date'2025-12-29' as d, date'2025-11-30' as sunday").select(
        fn.date_key(day), fn.iso_day_of_week(day), fn.iso_day_of_week(F.col("sunday")), F.weekofyear(day),
        fn.month_name_es(F.month(day)), fn.day_name_es(fn.iso_day_of_week(F.col("sunday"))),
        fn.month_start(day), fn.period_date(F.lit("2025-02")),
    ).first()
    assert tuple(row) == (20251229, 1, 7, 1, "Diciembre", "Domingo", date(2025, 12, 1), date(2025, 2, 1))


def test_text_helpers(spark):
    tags = fn.tag_list([("A", F.col("a")), ("B", F.col("b")), ("C", F.col("c"))])
    assert one(spark, tags, a=True, b=False, c=True) == "A,C"
    assert one(spark, tags, a=False, b=False, c=False) is None
    assert one(spark, fn.blank_to_null(F.col("v"), "N/A"), v="  x ") == "x"
    for empty in ("", "  ", " N/A"):
        assert one(spark, fn.blank_to_null(F.col("v"), "N/A"), v=empty) is None
    assert one(spark, fn.base_name(F.col("v")), v="a/b/c.parquet") == "c.parquet"
    assert one(spark, fn.base_name(F.col("v")), v="c.parquet") == "c.parquet"
    path = "yellow/yellow_tripdata_2025-07.parquet"
    assert one(spark, fn.period_of_file(F.col("v")), v=path) == date(2025, 7, 1)


def test_month_start_of_a_timestamp(spark):
    assert one(spark, fn.month_start(F.col("v")), v=datetime(2025, 7, 31, 23, 59)) == date(2025, 7, 1)
