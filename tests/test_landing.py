from datetime import UTC, datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from farestrata import schemas
from farestrata.operators import bronze
from farestrata.sources import landing

AT = datetime(2025, 6, 1, tzinfo=UTC)


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "yellow").mkdir()
    (tmp_path / "zones").mkdir()
    return tmp_path


def test_columns_by_name_ignoring_case(spark, folder):
    pq.write_table(
        pa.table({
            "VendorID": [1.0, 2.5],
            "Airport_fee": [1.75, None],
            "surprise": ["x", "y"],
            "tpep_pickup_datetime": pa.array([datetime(2025, 3, 9, 2, 30)] * 2, pa.timestamp("us")),
            "PULocationID": pa.array([1, 2], pa.int32()),
        }),
        folder / "yellow/yellow_tripdata_2025-03.parquet",
    )
    landed = landing.open_trips(spark, str(folder), "yellow_tripdata_2025-03.parquet")
    raw = landing.scan_trips(landed, AT)
    assert [(f.name, f.dataType) for f in raw.schema] == [(f.name, f.dataType) for f in schemas.RAW_TRIPS]
    first, second = raw.orderBy("_file_row_number").collect()
    assert (first.vendorid, second.vendorid, first.pulocationid) == (1, 3, 1)
    assert (first.airport_fee, second.airport_fee, first.total_amount) == (1.75, None, None)
    assert first.tpep_pickup_datetime == datetime(2025, 3, 9, 2, 30)
    assert [first._file_row_number, second._file_row_number] == [1, 2]
    assert first._source_file == "yellow/yellow_tripdata_2025-03.parquet"
    assert first._file_last_modified is not None
    drift = dict(bronze.schema_drift(landed.columns))
    assert drift["surprise"] == "unexpected" and drift["total_amount"] == "missing" and "vendorid" not in drift
    report = {r.column_name: (r.state, r.filled_rows) for r in bronze.schema_drift_report(landed).collect()}
    assert report["airport_fee"] == ("present", 1) and report["surprise"] == ("unexpected", 2)
    assert report["extra"] == ("missing", 0) and len(report) == 21


def test_inventory_lists_trip_files(spark, folder):
    for name in ("yellow_tripdata_2025-01.parquet", "notes.txt"):
        (folder / "yellow" / name).write_bytes(b"12345")
    before = landing.inventory(spark, str(folder)).collect()
    assert [(r.source_file, r.content_length) for r in before] == [("yellow_tripdata_2025-01.parquet", 5)]
    (folder / "yellow/yellow_tripdata_2025-01.parquet").write_bytes(b"123456")
    after = landing.inventory(spark, str(folder)).first()
    assert after.content_length == 6 and after.etag != before[0].etag


def test_zone_file(spark, folder):
    (folder / "zones/taxi_zone_lookup.csv").write_text(
        '"LocationID","Borough","Zone","service_zone"\n1,"EWR","Newark, Airport",EWR\n264,Unknown,N/A,N/A\n'
    )
    rows = landing.scan_zones(spark, str(folder), AT).orderBy("locationid").collect()
    assert [tuple(r)[:5] for r in rows] == [
        (1, "EWR", "Newark, Airport", "EWR", "zones/taxi_zone_lookup.csv"),
        (264, "Unknown", "N/A", "N/A", "zones/taxi_zone_lookup.csv"),
    ]
