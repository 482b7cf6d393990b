from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from farestrata.functions import whole
from farestrata.config import Limits
from farestrata.operators import bronze, silver
from trips import FILE, GOOD, distinct, raw

START = GOOD["tpep_pickup_datetime"]


def judge(spark, references, *changes, limits=Limits()):
    rows = bronze.bronze_trips(raw(spark, *changes))
    return silver.standardized_trips(rows, references, limits).orderBy("_file_row_number").collect()


def reasons(rows):
    return [r.rejection_reason for r in rows]


@pytest.mark.parametrize(("change", "reason"), [
    ({}, None),
    ({"tpep_pickup_datetime": None}, "MISSING_DATETIME"),
    ({"tpep_dropoff_datetime": None}, "MISSING_DATETIME"),
    ({"tpep_pickup_datetime": datetime(2025, 2, 28, 23, 0), "tpep_dropoff_datetime": datetime(2025, 3, 1)},
     "OUT_OF_PERIOD"),
    ({"tpep_dropoff_datetime": START}, "NON_POSITIVE_DURATION"),
    ({"tpep_dropoff_datetime": START - timedelta(minutes=1)}, "NON_POSITIVE_DURATION"),
    ({"tpep_dropoff_datetime": START + timedelta(hours=24)}, None),
    ({"tpep_dropoff_datetime": START + timedelta(hours=24, minutes=1)}, "EXCESSIVE_DURATION"),
    ({"fare_amount": None}, "MISSING_AMOUNT"),
    ({"total_amount": None}, "MISSING_AMOUNT"),
    ({"tip_amount": -0.01}, "NEGATIVE_AMOUNT"),
    ({"total_amount": 1000.0}, None),
    ({"total_amount": 1000.01}, "EXCESSIVE_AMOUNT"),
    ({"trip_distance": 200.0}, None),
    ({"trip_distance": 200.01}, "INVALID_DISTANCE"),
    ({"trip_distance": -0.01}, "INVALID_DISTANCE"),
    ({"trip_distance": 0.0}, None),
    ({"trip_distance": 0.0, "total_amount": 0.0}, "EMPTY_TRIP"),
    ({"trip_distance": None}, None),
])
def test_single_rules(spark, references, change, reason):
    (row,) = judge(spark, references, change)
    assert row.rejection_reason == reason
    assert row.is_valid is (reason is None)
    assert row.dq_issues == reason


def test_first_broken_rule_names_the_rejection(spark, references):
    broken = {"tpep_dropoff_datetime": START, "fare_amount": None, "tip_amount": -1.0, "trip_distance": 300.0}
    rows = judge(spark, references, broken, broken)
    assert reasons(rows) == ["NON_POSITIVE_DURATION", "DUPLICATE"]
    assert rows[1].dq_issues == "DUPLICATE,NON_POSITIVE_DURATION,MISSING_AMOUNT,NEGATIVE_AMOUNT,INVALID_DISTANCE"


def test_missing_datetime_outranks_duplicate(spark, references):
    gone = {"tpep_pickup_datetime": None, "tpep_dropoff_datetime": None}
    rows = judge(spark, references, gone, gone)
    assert reasons(rows) == ["MISSING_DATETIME"] * 2
    assert [r.dq_duplicate for r in rows] == [False, True]


def test_smallest_row_number_is_kept(spark, references):
    rows = judge(spark, references, {"_file_row_number": 30}, {"_file_row_number": 10}, {"_file_row_number": 20})
    assert [(r._file_row_number, r.is_valid) for r in rows] == [(10, True), (20, False), (30, False)]


def test_first_copy_failing_outside_the_key_loses_the_trip(spark, references):
    assert reasons(judge(spark, references, {"tip_amount": -1.0}, {})) == ["NEGATIVE_AMOUNT", "DUPLICATE"]


def test_same_trip_in_two_files_is_not_a_duplicate(spark, references):
    other = "yellow/yellow_tripdata_2025-04.parquet"
    rows = judge(spark, references, {}, {"_source_file": other})
    assert sorted(map(str, reasons(rows))) == ["None", "OUT_OF_PERIOD"]


def test_two_unknown_codes_collide(spark, references):
    assert reasons(judge(spark, references, {"vendorid": 77}, {"vendorid": 88})) == [None, "DUPLICATE"]


def test_unknown_members_and_their_tags(spark, references):
    (row,) = judge(spark, references, {
        "vendorid": 3, "ratecodeid": None, "payment_type": 9, "pulocationid": 900, "dolocationid": None,
        "passenger_count": 0, "store_and_fwd_flag": "?",
    })
    assert (row.vendor_id, row.rate_code_id, row.payment_type_id) == (-1, 99, 5)
    assert (row.pickup_location_id, row.dropoff_location_id) == (264, 264)
    assert row.passenger_count is None and row.is_store_and_forward is None and row.is_valid
    assert row.dq_imputations == (
        "VENDOR,PASSENGER_COUNT,RATE_CODE,PICKUP_LOCATION,DROPOFF_LOCATION,PAYMENT_TYPE,STORE_AND_FWD_FLAG"
    )


def test_reported_unknown_members(spark, references):
    """A reported -1 vendor counts as imputed; reported 99, 5 and 264 are ordinary codes."""
    (row,) = judge(spark, references, {"vendorid": -1, "ratecodeid": 99, "payment_type": 5, "pulocationid": 264})
    assert row.dq_imputations == "VENDOR"


@pytest.mark.parametrize(("reported", "kept"), [(None, None), (0, None), (1, 1), (6, 6), (7, None)])
def test_passengers(spark, references, reported, kept):
    (row,) = judge(spark, references, {"passenger_count": reported})
    assert row.passenger_count == kept and row.is_valid


def test_missing_charges_become_zero_and_flags_booleans(spark, references):
    rows = judge(spark, references, {"extra": None, "store_and_fwd_flag": " y"}, distinct(1))
    assert rows[0].extra_amount == Decimal("0.00") and rows[0].is_store_and_forward is True
    assert rows[1].extra_amount == Decimal("1.00") and rows[1].is_store_and_forward is False


def test_other_limits(spark, references):
    tight = Limits(max_trip_hours=0, max_trip_miles=4, max_total_amount=10, max_passengers=0)
    (row,) = judge(spark, references, {}, limits=tight)
    assert row.dq_issues == "EXCESSIVE_DURATION,EXCESSIVE_AMOUNT,INVALID_DISTANCE"
    assert row.passenger_count is None


def test_fractional_codes_are_rounded(spark):
    rows = bronze.bronze_trips(raw(spark, {})).withColumn("vendorid", F.lit(1.0)).withColumn("ratecodeid", F.lit(2.5))
    row = silver.typed(rows).first()
    assert (row.vendor_id_reported, row.rate_code_id_reported) == (1, 3)


def test_a_group_with_a_third_of_all_rows(spark, references):
    """Brute force on a frame whose largest group of copies dominates."""
    n = 3000
    changes = [{} if i % 3 == 0 else distinct(i % 700 + 1) for i in range(n)]
    rows = judge(spark, references, *changes)
    seen, expected = set(), []
    for change in changes:
        key = change.get("trip_distance", 5.0)
        expected.append(key in seen)
        seen.add(key)
    assert [r.dq_duplicate for r in rows] == expected


def test_shuffled_and_broadcast_marking_agree(spark, references):
    rows = bronze.bronze_trips(raw(spark, *[distinct(i % 5) for i in range(40)]))
    standardized = silver.standardize(silver.typed(rows), references)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    marked = {}
    try:
        for limit in (before, "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            got = silver.mark_duplicates(standardized).orderBy("_file_row_number").collect()
            marked[limit] = [r.dq_duplicate for r in got]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert marked[before] == marked["-1"] == [False] * 5 + [True] * 35


def test_summary_counts(spark, references):
    rows = bronze.bronze_trips(raw(spark, {}, {}, {"tip_amount": -1.0, **distinct(1)}, {"passenger_count": 0, **distinct(2)}))
    row = silver.quality_summary(silver.standardized_trips(rows, references)).first()
    assert (row.total_records, row.valid_records, row.rejected_records) == (4, 2, 2)
    assert row.pct_valid == Decimal("50.00")
    assert (row.rejected_duplicate, row.rejected_negative_amount, row.rejected_empty_trip) == (1, 1, 0)
    assert (row.records_with_imputations, row.passenger_count_unknown) == (1, 1)


def test_valid_and_rejected_split_every_record(spark, references):
    rows = bronze.bronze_trips(raw(spark, {}, {}, distinct(1), {"fare_amount": None}))
    judged = silver.standardized_trips(rows, references)
    assert judged.columns == silver.EVALUATED_COLUMNS
    valid, rejected = silver.valid_trips(judged), silver.rejected_trips(judged)
    assert (valid.count(), rejected.count()) == (2, 2)
    assert valid.columns == silver.VALID_COLUMNS and rejected.columns == silver.REJECTED_COLUMNS


def test_zones(spark):
    rows = [(1, " EWR ", "Newark Airport", "EWR"), (4, "Unknown", "Unknown", "Unknown"), (5, "", "  ", None),
            (265, "N/A", "Outside of NYC", "N/A")]
    frame = spark.createDataFrame(rows, "locationid bigint, borough string, zone string, service_zone string")
    got = [tuple(r) for r in silver.clean_zones(frame).orderBy("location_id").collect()]
    assert got == [
        (1, "EWR", "Newark Airport", "EWR", True, False),
        (4, "Unknown", "Unknown", "Unknown", False, True),
        (5, "Unknown", "Unknown", "Unknown", False, True),
        (265, "Outside of NYC", "Outside of NYC", "Outside of NYC", False, True),
    ]


def test_bronze_lineage(spark):
    import hashlib

    row = bronze.bronze_trips(raw(spark, {})).first()
    assert row._record_id == hashlib.md5(f"{FILE}-1".encode()).hexdigest()
    assert str(row._source_period) == "2025-03-01"


def test_codes_beyond_32_bits_are_unknown_members(spark):
    row = spark.range(1).selectExpr("5000000000 as code", "5000000000.0D as fraction")
    wide = row.select(F.col("code").try_cast("int").alias("a"), whole("fraction").alias("b")).first()
    assert wide.a is None and wide.b is None
