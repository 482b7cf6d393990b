from decimal import Decimal

from farestrata import refs
from farestrata.config import Calendar
from farestrata.operators import bronze, gold, marts, silver
from trips import distinct, raw


def test_default_calendar(spark):
    days = gold.dim_date(spark)
    assert days.count() == 2557
    row = days.where("date_key = 20241229").first()
    assert (row.year_month, row.month_name, row.day_name) == ("2024-12", "Diciembre", "Domingo")
    assert (row.day_of_week, row.iso_week, row.is_weekend, row.calendar_quarter) == (7, 52, True, 4)
    assert str(days.agg({"full_date": "max"}).first()[0]) == "2030-12-31"


def test_empty_calendar(spark):
    assert gold.dim_date(spark, Calendar("2025-01-01", "2025-01-01")).count() == 0


def test_hours(spark):
    rows = {r.time_key: r for r in gold.dim_time(spark).collect()}
    assert len(rows) == 24
    assert rows[7].hour_label == "07:00 - 07:59"
    parts = [rows[h].day_part for h in (0, 5, 6, 11, 12, 17, 18, 23)]
    assert parts == ["Madrugada"] * 2 + ["Mañana"] * 2 + ["Tarde"] * 2 + ["Noche"] * 2
    assert [h for h, r in rows.items() if r.is_peak_hour] == [7, 8, 9, 16, 17, 18, 19]


def test_code_dimensions(spark):
    rates = {r.rate_code_id: r for r in gold.dim_rate_code(refs.rate_codes(spark)).collect()}
    assert [k for k, r in sorted(rates.items()) if r.is_airport_rate] == [2, 3]
    assert rates[99].rate_code_description == "Desconocido"
    payments = {r.payment_type_id: r for r in gold.dim_payment_type(refs.payment_types(spark)).collect()}
    assert [k for k, r in payments.items() if r.is_card_payment] == [1]
    assert {r.vendor_id for r in gold.dim_vendor(refs.vendors(spark)).collect()} == {1, 2, 6, 7, -1}


def star(spark, references, *changes):
    judged = silver.standardized_trips(bronze.bronze_trips(raw(spark, *changes)), references)
    return marts.Star(
        fact=gold.fct_trips(silver.valid_trips(judged)),
        date=gold.dim_date(spark),
        time=gold.dim_time(spark),
        zone=gold.dim_zone(references.zones),
        payment_type=gold.dim_payment_type(references.payment_types),
    )


def test_fact_keys_meet_the_dimensions(spark, references):
    s = star(spark, references, {}, {"pulocationid": 999, "vendorid": 50, **distinct(1)})
    joined = s.fact.join(s.zone, s.fact.pickup_zone_key == s.zone.zone_key)
    assert {r.location_id for r in joined.collect()} == {1, 264}
    row = s.fact.first()
    assert (row.pickup_date_key, row.pickup_time_key, row.trip_count) == (20250310, 8, 1)


def test_marts(spark, references):
    s = star(
        spark, references,
        {"total_amount": 10.0, "tip_amount": 1.0, "fare_amount": 8.0},
        {"total_amount": 11.0, "tip_amount": 2.0, "fare_amount": 9.0, "cbd_congestion_fee": 0.0},
        {"total_amount": 12.0, "payment_type": 2, "fare_amount": 0.0, "pulocationid": 264, "dolocationid": 900},
    )
    assert [tuple(r) for r in marts.monthly_revenue(s).collect()] == [("2025-03", 3, Decimal("33.00"), Decimal("11.00"))]
    assert [tuple(r) for r in marts.demand_by_day_part(s).collect()] == [("Lunes", "Mañana", 3)]
    assert [tuple(r) for r in marts.tip_pct_by_payment(s).collect()] == [
        ("Tarjeta de crédito", 2, Decimal("17.65")), ("Efectivo", 1, None)
    ]
    assert [tuple(r) for r in marts.surcharge_by_month(s).collect()] == [("2025-03", Decimal("1.50"), 2)]
    assert [tuple(r) for r in marts.top_routes(s, limit=1).collect()] == [("Zone 1", "Zone 2", 2, Decimal("5.00"))]


def test_zones_sharing_a_name_are_one_route(spark, references):
    s = star(spark, references, {"pulocationid": 264}, {"pulocationid": 264, **distinct(1)}, {"pulocationid": 1})
    routes = {(r.zona_recogida, r.viajes) for r in marts.top_routes(s).collect()}
    assert routes == {("Unknown", 2), ("Zone 1", 1)}
