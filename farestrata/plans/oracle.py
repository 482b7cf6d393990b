"""The registered queries once more, as DuckDB SQL over the same tables.

Written apart from the Spark code and in other terms (lists of issues instead of rule tables, window minimum instead
of grouped minimum, integer arithmetic instead of decimal division), so that agreement means something.
"""

from __future__ import annotations

import re

from farestrata.config import MONEY_COLUMNS, TRIP_COLUMNS
from farestrata.operators.checks import TableChecks
from farestrata.operators.silver import EVALUATED_COLUMNS, REASONS, REJECTED_COLUMNS, VALID_COLUMNS
from farestrata.plans import suites
from farestrata.refs import PAYMENT_TYPES, RATE_CODES, VENDORS

MONEY = list(MONEY_COLUMNS.values())
AMOUNT = "decimal(18,2)"


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join("'" + v + "'" if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)


def _key(*columns: str) -> str:
    parts = ", ".join(f"coalesce(cast({c} as varchar), '_dbt_utils_surrogate_key_null_')" for c in columns)
    return f"md5(concat_ws('-', {parts}))"


def _day_key(moment: str) -> str:
    return f"cast(strftime({moment}, '%Y%m%d') as integer)"


def _half_up(numerator: str, denominator: str) -> str:
    """numerator / denominator rounded half up to a whole number, for non-negative integers."""
    return f"((2 * ({numerator}) + ({denominator})) // (2 * ({denominator})))"


def _cents(column: str) -> str:
    return f"cast(sum({column}) * 100 as hugeint)"


_CHARGES = [m for m in MONEY if m not in ("fare_amount", "total_amount")]
_COPY_KEY = """_source_file, vendor_id, pickup_datetime, dropoff_datetime, pickup_location_id, dropoff_location_id,
    trip_distance_miles, fare_amount, total_amount"""

CTES = {
    "vendors": f"select * from (values {_values(VENDORS)}) v(vendor_id, vendor_name)",
    "rate_codes": f"""select * from (values {_values(RATE_CODES)})
        v(rate_code_id, rate_code_name, rate_code_description)""",
    "payment_types": f"""select * from (values {_values(PAYMENT_TYPES)})
        v(payment_type_id, payment_type_name, payment_type_description)""",
    "zones": """
        select cast(n_nationkey as bigint) as locationid,
          case n_nationkey % 7 when 0 then 'N/A' when 1 then concat(' ', r_name, ' ') when 2 then ''
            when 3 then 'Unknown' else r_name end as borough,
          case n_nationkey % 5 when 0 then 'N/A' when 1 then '' else n_name end as zone,
          case n_nationkey % 3 when 0 then 'Boro Zone' when 1 then 'Yellow Zone' else 'N/A' end as service_zone
        from nation join region on n_regionkey = r_regionkey
        union all values (264, 'Unknown', 'N/A', 'N/A'), (265, 'N/A', 'Outside of NYC', 'N/A')""",
    "zones_clean": """
        select cast(locationid as integer) as location_id,
          case when trim(borough) in ('', 'N/A', 'Unknown') or borough is null
            then if(trim(zone) = 'Outside of NYC', 'Outside of NYC', 'Unknown') else trim(borough) end as borough,
          case when trim(zone) in ('', 'N/A') or zone is null then 'Unknown' else trim(zone) end as zone_name,
          case when trim(service_zone) in ('', 'N/A') or service_zone is null
            then if(trim(zone) = 'Outside of NYC', 'Outside of NYC', 'Unknown') else trim(service_zone)
            end as service_zone,
          locationid in (1, 132, 138) as is_airport,
          coalesce(trim(borough) in ('', 'N/A', 'Unknown'), true) as is_unknown_location
        from zones""",
    "numbered": """
        select *, (((row_number() over (
              partition by l_orderkey, l_linenumber % 8, l_suppkey % 16
              order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate,
                l_returnflag nulls first, l_linestatus nulls first) - 1)
            * (select max(l_orderkey) + 1 from lineitem) + l_orderkey) * 8 + l_linenumber % 8) * 16
            + l_suppkey % 16 as line_id
        from lineitem""",
    "lines": """
        select n.*, o_orderdate, o_custkey, copy_no,
          case when l_linestatus = 'F' and l_tax = 0.01 and l_linenumber = 6 then null
            else o_orderdate + to_seconds(l_partkey % 24 * 3600 + l_suppkey % 60 * 60) end as pickup,
          cast(date_trunc('month', if(l_linenumber = 2 and l_tax = 0.06, l_shipdate, o_orderdate)) as date) as period
        from numbered n join orders on l_orderkey = o_orderkey
        join (values (0), (1)) c(copy_no) on copy_no = 0 or l_suppkey % 50 = 0""",
    "raw": """
        select l_suppkey % 9 - 1 as vendorid,
          pickup as tpep_pickup_datetime,
          case when l_linestatus = 'O' and l_tax = 0.03 and l_linenumber = 1 then null
            else pickup + to_seconds((l_orderkey * 7919 + l_partkey * 31) % 90000 - 1500) end as tpep_dropoff_datetime,
          cast(nullif(l_linenumber, 3) as bigint) as passenger_count,
          (l_quantity - 2) * 4.25::double as trip_distance,
          if(l_partkey % 8 = 7, 99, nullif(l_partkey % 8, 0)) as ratecodeid,
          case l_returnflag when 'A' then ' y' when 'N' then 'N ' end as store_and_fwd_flag,
          case o_custkey % 30 when 29 then 264 when 28 then null else o_custkey % 30 end as pulocationid,
          l_suppkey % 27 as dolocationid,
          nullif(l_orderkey % 9, 8) as payment_type,
          case when l_tax = 0.08 and l_linenumber = 5 then null
            else floor(l_extendedprice + 0.5::double) / 100::double end as fare_amount,
          case when l_linenumber > 1 then l_linenumber * 0.5::double end as extra,
          0.5::double as mta_tax,
          if(l_returnflag = 'R' and l_tax = 0.07, -1, 1) * floor(l_tax * 100::double + 0.5::double) as tip_amount,
          case when l_suppkey % 3 = 0 then 6.25::double end as tolls_amount,
          1.0::double as improvement_surcharge,
          floor(l_extendedprice * l_discount * 10::double + 0.5::double) / 100::double as total_amount,
          case when l_linestatus = 'O' then 2.5::double end as congestion_surcharge,
          case when l_partkey % 10 = 0 then 1.75::double end as airport_fee,
          case when l_suppkey % 4 = 0 then 0.75::double end as cbd_congestion_fee,
          concat('yellow/yellow_tripdata_', strftime(period, '%Y-%m'), '.parquet') as _source_file,
          line_id * 2 + copy_no as _file_row_number,
          period + interval 35 days as _file_last_modified,
          period + interval 40 days as _loaded_at
        from lines""",
    "bronze": f"""
        select * exclude (_source_file, _file_row_number, _file_last_modified, _loaded_at),
          {_key('_source_file', '_file_row_number')} as _record_id, _source_file,
          cast(concat(regexp_extract(_source_file, '([0-9-]{{7}}).parquet$', 1), '-01') as date) as _source_period,
          _file_row_number, _file_last_modified, _loaded_at
        from raw""",
    "typed": f"""
        select _record_id as trip_id, cast(vendorid as integer) as vendor_id_reported,
          tpep_pickup_datetime as pickup_datetime, tpep_dropoff_datetime as dropoff_datetime,
          cast(passenger_count as integer) as passenger_count_reported,
          cast(trip_distance as {AMOUNT}) as trip_distance_miles,
          cast(ratecodeid as integer) as rate_code_id_reported,
          upper(trim(store_and_fwd_flag)) as store_and_fwd_flag_reported,
          cast(pulocationid as integer) as pickup_location_id_reported,
          cast(dolocationid as integer) as dropoff_location_id_reported,
          cast(payment_type as integer) as payment_type_id_reported,
          {', '.join(f'cast({s} as {AMOUNT}) as {t}_reported' for s, t in MONEY_COLUMNS.items())},
          _source_file, _source_period, _file_row_number, _loaded_at
        from bronze""",
    "checked": """
        select *,
          coalesce(vendor_id_reported in (select vendor_id from vendors where vendor_id > 0), false) as ok_vendor,
          coalesce(passenger_count_reported in (1, 2, 3, 4, 5, 6), false) as ok_passengers,
          coalesce(rate_code_id_reported in (select rate_code_id from rate_codes), false) as ok_rate,
          coalesce(pickup_location_id_reported in (select locationid from zones), false) as ok_pickup,
          coalesce(dropoff_location_id_reported in (select locationid from zones), false) as ok_dropoff,
          coalesce(payment_type_id_reported in (select payment_type_id from payment_types), false) as ok_payment,
          coalesce(store_and_fwd_flag_reported in ('Y', 'N'), false) as ok_flag
        from typed""",
    "standardized": f"""
        select trip_id, if(ok_vendor, vendor_id_reported, -1) as vendor_id, pickup_datetime, dropoff_datetime,
          if(ok_passengers, passenger_count_reported, null) as passenger_count, trip_distance_miles,
          cast((epoch_ms(dropoff_datetime) // 1000 - epoch_ms(pickup_datetime) // 1000) / 60.0 as {AMOUNT})
            as trip_duration_minutes,
          if(ok_rate, rate_code_id_reported, 99) as rate_code_id,
          if(ok_flag, store_and_fwd_flag_reported = 'Y', null) as is_store_and_forward,
          if(ok_pickup, pickup_location_id_reported, 264) as pickup_location_id,
          if(ok_dropoff, dropoff_location_id_reported, 264) as dropoff_location_id,
          if(ok_payment, payment_type_id_reported, 5) as payment_type_id,
          fare_amount_reported as fare_amount,
          {', '.join(f'cast(ifnull({m}_reported, 0) as {AMOUNT}) as {m}' for m in _CHARGES)},
          total_amount_reported as total_amount,
          vendor_id_reported, passenger_count_reported, rate_code_id_reported, store_and_fwd_flag_reported,
          pickup_location_id_reported, dropoff_location_id_reported, payment_type_id_reported,
          nullif(concat_ws(',', if(ok_vendor, null, 'VENDOR'), if(ok_passengers, null, 'PASSENGER_COUNT'),
            if(ok_rate, null, 'RATE_CODE'), if(ok_pickup, null, 'PICKUP_LOCATION'),
            if(ok_dropoff, null, 'DROPOFF_LOCATION'), if(ok_payment, null, 'PAYMENT_TYPE'),
            if(ok_flag, null, 'STORE_AND_FWD_FLAG')), '') as dq_imputations,
          _source_file, _source_period, _file_row_number, _loaded_at
        from checked""",
    "flagged": f"""
        select *,
          (pickup_datetime is null or dropoff_datetime is null) as dq_missing_datetime,
          _file_row_number <> min(_file_row_number) over (partition by {_COPY_KEY}) as dq_duplicate,
          ifnull(strftime(pickup_datetime, '%Y%m') <> strftime(_source_period, '%Y%m'), false) as dq_out_of_period,
          ifnull(pickup_datetime >= dropoff_datetime, false) as dq_non_positive_duration,
          ifnull(trip_duration_minutes > 1440, false) as dq_excessive_duration,
          (fare_amount is null or total_amount is null) as dq_missing_amount,
          least({', '.join(MONEY)}) < 0 as dq_negative_amount,
          ifnull(total_amount > 1000, false) as dq_excessive_amount,
          ifnull(trip_distance_miles not between 0 and 200, false) as dq_invalid_distance,
          ifnull(trip_distance_miles = 0, false) and ifnull(total_amount = 0, false) as dq_empty_trip
        from standardized""",
    "issues": f"""
        select *, nullif(concat_ws(',', {', '.join(f"if(dq_{r.lower()}, '{r}', null)" for r in REASONS)}), '') as dq_issues
        from flagged""",
    "judged": """
        select *, nullif(split_part(dq_issues, ',', 1), '') as rejection_reason, dq_issues is null as is_valid
        from issues""",
    "valid": f"select {', '.join(VALID_COLUMNS)} from judged where is_valid",
    "fact": f"""
        select trip_id as trip_key, {_day_key('pickup_datetime')} as pickup_date_key,
          cast(hour(pickup_datetime) as integer) as pickup_time_key,
          {_day_key('dropoff_datetime')} as dropoff_date_key,
          cast(hour(dropoff_datetime) as integer) as dropoff_time_key,
          {_key('pickup_location_id')} as pickup_zone_key, {_key('dropoff_location_id')} as dropoff_zone_key,
          {_key('vendor_id')} as vendor_key, {_key('rate_code_id')} as rate_code_key,
          {_key('payment_type_id')} as payment_type_key, pickup_datetime, dropoff_datetime, is_store_and_forward,
          1 as trip_count, passenger_count, trip_distance_miles, trip_duration_minutes, {', '.join(MONEY)},
          _source_file, _source_period, _loaded_at
        from valid""",
    "days": """
        select cast(unnest(generate_series(date_trunc('year', min(o_orderdate)),
          date_trunc('year', max(o_orderdate)) + interval 1 year - interval 1 day, interval 1 day)) as date) as d
        from orders""",
    "calendar": f"""
        select {_day_key('d')} as date_key, d as full_date, cast(year(d) as integer) as calendar_year,
          cast(quarter(d) as integer) as calendar_quarter, cast(month(d) as integer) as calendar_month,
          ['Enero', 'Febrero', 'Marzo', 'Abril', 'Mayo', 'Junio', 'Julio', 'Agosto', 'Septiembre', 'Octubre',
            'Noviembre', 'Diciembre'][month(d)] as month_name,
          strftime(d, '%Y-%m') as year_month, cast(day(d) as integer) as day_of_month,
          cast(isodow(d) as integer) as day_of_week,
          ['Lunes', 'Martes', 'Miércoles', 'Jueves', 'Viernes', 'Sábado', 'Domingo'][isodow(d)] as day_name,
          cast(weekofyear(d) as integer) as iso_week, isodow(d) > 5 as is_weekend
        from days""",
    "hours": """
        select cast(h as integer) as time_key, cast(h as integer) as hour_of_day,
          format('{:02d}:00 - {:02d}:59', h, h) as hour_label,
          ['Madrugada', 'Mañana', 'Tarde', 'Noche'][h // 6 + 1] as day_part,
          h in (7, 8, 9, 16, 17, 18, 19) as is_peak_hour
        from range(24) r(h)""",
    "files": """
        select string_split(_source_file, '/')[-1] as source_file, _source_file as path,
          cast(concat(substr(_source_file, -15, 7), '-01') as date) as source_period,
          cast(substr(_source_file, -10, 2) as integer) as m, count(*) as n
        from raw group by all""",
    "ledger": """
        select source_file, 'yellow_tripdata' as dataset, source_period, concat('landing/', path) as source_url,
          if(m = 8, null, md5(concat_ws('-', source_file, n))) as etag, if(m = 8, null, n * 100) as content_length,
          cast(null as varchar) as source_last_modified, if(m in (5, 8), null, n) as file_rows,
          case when m in (5, 8) then null when m = 4 then 0 when m = 9 then n + 1 else n end as rows_loaded,
          cast(null as varchar) as source_columns,
          case m when 5 then 'FAILED' when 8 then 'NOT_AVAILABLE' else 'LOADED' end as status, 'ok' as message,
          1 as attempts, source_period + interval 41 days as updated_at
        from files where m <> 7""",
    "inventory": """
        select source_file, md5(concat_ws('-', if(m = 3, 'new', null), source_file, n)) as etag,
          n * 100 + if(m = 6, 1, 0) as content_length
        from files where m <> 12""",
    "expected": """
        select cast(p as date) as source_period, concat('yellow_tripdata_', strftime(p, '%Y-%m'), '.parquet')
          as source_file
        from (select unnest(generate_series(min(source_period), max(source_period) + interval 3 months,
          interval 1 month)) as p from files)""",
    "plan": """
        with seen as (
          select e.source_file, e.source_period, i.source_file is not null as published,
            ifnull(l.status = 'LOADED', false) as loaded, i.etag, i.content_length, l.rows_loaded, ifnull(f.n, 0) as n,
            l.etag is not distinct from i.etag and ifnull(l.content_length, 0) = i.content_length
              and l.rows_loaded <> 0 and l.rows_loaded = ifnull(f.n, 0) as same
          from expected e left join inventory i using (source_file) left join ledger l using (source_file)
          left join files f using (source_file)),
        decided as (
          select *, case when published then if(loaded and same, 'SKIPPED', 'LOAD')
            else if(loaded, 'SKIPPED', 'NOT_AVAILABLE') end as action from seen)
        select source_file, source_period, action,
          case when action <> 'SKIPPED' then 0 when published then n else ifnull(rows_loaded, 0) end as rows_kept,
          etag, content_length
        from decided""",
    "results": """
        select p.source_file, p.source_period, f.n, f.m, p.etag, p.content_length,
          case when action <> 'LOAD' then action when m = 9 then 'FAILED' else 'LOADED' end as status,
          case when action <> 'LOAD' then rows_kept when m = 9 then 0 else n end as rows
        from plan p left join files f using (source_file)""",
    "entries": """
        select source_file, 'yellow_tripdata' as dataset, source_period,
          concat('landing/yellow/', source_file) as source_url, etag, content_length,
          cast(null as varchar) as source_last_modified, if(status = 'LOADED', n, null) as file_rows,
          if(status = 'LOADED', n, null) as rows_loaded, cast(null as varchar) as source_columns, status,
          if(status = 'FAILED', repeat('x', 2000), 'ok') as message, source_period + interval 60 days as updated_at
        from results where status <> 'SKIPPED'""",
}


def _query(select: str, ctes: dict[str, str] = CTES) -> str:
    """Prefix the select with the common table expressions it needs, in order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in ctes:
            if name not in needed and re.search(rf"\b(?:from|join)\s+{name}\b", text):
                needed.add(name)
                visit(ctes[name])

    visit(select)
    if not needed:
        return select
    return "with " + ",\n".join(f"{n} as materialized ({ctes[n]})" for n in ctes if n in needed) + "\n" + select


def _doubles(columns: list[str]) -> str:
    exact = {*MONEY, *[f"{m}_reported" for m in MONEY], "trip_distance_miles", "trip_duration_minutes"}
    return ", ".join(f"cast({c} as double) as {c}" if c in exact else c for c in columns)


def _checks(table: str, source: str, *rules: tuple[str, str, str]) -> str:
    """Rules are (check, column, condition that breaks it)."""
    return " union all ".join(
        f"""select '{check}' as "check", '{table}' as "table", '{column}' as "column",
          count(*) filter (where {broken}) as failures from {source}"""
        for check, column, broken in rules
    )


_TYPED = ["trip_id", "vendor_id_reported", "pickup_datetime", "dropoff_datetime", "passenger_count_reported",
          "trip_distance_miles", "rate_code_id_reported", "store_and_fwd_flag_reported", "pickup_location_id_reported",
          "dropoff_location_id_reported", "payment_type_id_reported", *[f"{m}_reported" for m in MONEY],
          "_source_file", "_source_period", "_file_row_number", "_loaded_at"]
_AUDIT = ["vendor_id_reported", "passenger_count_reported", "rate_code_id_reported", "store_and_fwd_flag_reported",
          "pickup_location_id_reported", "dropoff_location_id_reported", "payment_type_id_reported"]
_STANDARDIZED = [c for c in EVALUATED_COLUMNS
                 if c not in ("rejection_reason", "dq_issues", "is_valid") and (c[:3] != "dq_" or c == "dq_imputations")]
_FACT = ["trip_key", "pickup_date_key", "pickup_time_key", "dropoff_date_key", "dropoff_time_key", "pickup_zone_key",
         "dropoff_zone_key", "vendor_key", "rate_code_key", "payment_type_key", "pickup_datetime", "dropoff_datetime",
         "is_store_and_forward", "trip_count", "passenger_count", "trip_distance_miles", "trip_duration_minutes",
         *MONEY, "_source_file", "_source_period", "_loaded_at"]


def _used(dimension: str, key: str, *uses: tuple[str, str]) -> str:
    """Members of a dimension with the number of trips that point to them."""
    counts = ", ".join(f"(select count(*) from fact where {fk} = d.{key}) as {name}" for fk, name in uses)
    return f"select d.*, {counts} from ({dimension}) d"


def _mismatch(left: str, right: str, left_name: str, right_name: str) -> str:
    return f"""
        select ifnull(a._source_file, b._source_file) as source_file, a.n as {left_name}, b.n as {right_name}
        from (select _source_file, count(*) as n from {left} group by 1) a
        full join (select _source_file, count(*) as n from {right} group by 1) b on a._source_file = b._source_file
        where a.n is distinct from b.n"""


def _file_of(*months: int) -> str:
    return " or ".join(f"_source_file like '%-{m:02d}.parquet'" for m in months)


_RELOADED = f"""
    select * replace (total_amount + if({_file_of(3)}, 1, 0) as total_amount,
      _loaded_at + if({_file_of(3)}, interval 30 days, interval 0 days) as _loaded_at)
    from {{source}} where not ({_file_of(6)})"""

_LEDGER_MISMATCHES = """
    select l.source_file, l.rows_loaded, f.n as raw_rows from ledger l
    left join files f on suffix(f.path, l.source_file)
    where l.status = 'LOADED' and ifnull(f.n, -1) <> l.rows_loaded"""

#: What stands for the stored tables.
_STORED = {
    "raw.trips": "raw",
    "raw.zones": "zones",
    "raw.ledger": "(select '' as source_file where false)",
    "bronze.trips": "bronze",
    "bronze.zones": "(select *, 'zones' as _source_file, 0 as _loaded_at from zones)",
    "silver.vendors": "vendors",
    "silver.rate_codes": "rate_codes",
    "silver.payment_types": "payment_types",
    "silver.zones": "(select * from zones_clean where location_id <> 7)",
    "silver.standardized": "judged",
    "silver.valid": "valid",
    "silver.rejected": "(select trip_id, rejection_reason from judged where not is_valid)",
    "silver.quality_summary": "(select distinct _source_period as source_period from judged)",
    "gold.fct_trips": "fact",
    "gold.dim_date": f"""(select {_day_key('d')} as date_key, cast(d as date) as full_date
        from generate_series(timestamp '2024-01-01', timestamp '2030-12-31', interval 1 day) g(d))""",
    "gold.dim_time": "(select * from hours where time_key <> 3)",
    "gold.dim_zone": f"(select {_key('location_id')} as zone_key, * from zones_clean)",
    "gold.dim_vendor": f"(select {_key('vendor_id')} as vendor_key, * from vendors)",
    "gold.dim_rate_code": f"(select {_key('rate_code_id')} as rate_code_key, * from rate_codes)",
    "gold.dim_payment_type": f"(select {_key('payment_type_id')} as payment_type_key, * from payment_types)",
}
_REPEATED_TRIPS = """(select 1 from valid group by vendor_id, pickup_datetime, dropoff_datetime, pickup_location_id,
    dropoff_location_id, trip_distance_miles, fare_amount, total_amount having count(*) > 1)"""


def _declared(spec: TableChecks) -> list[str]:
    """One select per declared check."""
    source = _STORED[spec.table]

    def one(check: str, column: str, failures: str) -> str:
        return f"""select '{check}' as "check", '{spec.table}' as "table", '{column}' as "column", ({failures}) as failures"""

    def rows(condition: str) -> str:
        return f"select count(*) from {source} where {condition}"

    found = [one("not_null", c, rows(f"{c} is null")) for c in spec.not_null]
    found += [
        one("accepted_values", c, rows(f"{c} not in ({', '.join(repr(v) for v in values)})"))
        for c, values in spec.accepted_values.items()
    ]
    found += [one("accepted_range", c, rows(f"{c} < {a} or {c} > {b}")) for c, (a, b) in spec.accepted_range.items()]
    found += [one("expression_is_true", e, rows(f"not ({e})")) for e in spec.expressions]
    found += [
        one("unique", c, f"select count(*) from (select 1 from {source} where {c} is not null group by {c} having count(*) > 1)")
        for c in spec.unique
    ]
    found += [
        one("relationships", r.column, rows(f"{r.column} is not null and {r.column} not in (select {r.key} from {_STORED[r.table]})"))
        for r in spec.relationships
    ]
    return found


def _all_checks() -> str:
    between = {
        "raw": {"raw matches ledger": "0"},
        "bronze": {"bronze matches raw": "0"},
        "silver": {"silver keeps every record": "0", "valid holds what was judged valid": "0",
                   "no repeated trips": f"select count(*) from {_REPEATED_TRIPS}"},
        "gold": {"fact matches valid trips": "0", "every loaded file reaches the fact": "0"},
    }
    found = [select for specs in suites.LAYERS.values() for spec in specs for select in _declared(spec)]
    found += [
        f"select 'reconciliation', '{layer}', '{name}', ({failures if failures != '0' else 'select 0'})"
        for layer, named in between.items() for name, failures in named.items()
    ]
    return " union all ".join(found)


QUERIES = {
    "bronze_trips": "select * from bronze",
    "append_new_columns": """
        select _source_file, count(*) as row_count,
          count(case when _source_file >= 'yellow/yellow_tripdata_2000' then cbd_congestion_fee end) as with_cbd_fee
        from raw group by 1""",
    "schema_drift_report": " union all ".join(
        [f"select '{c}' as column_name, 'present' as state, count({c}) as filled_rows from raw"
         for c in TRIP_COLUMNS if c != "cbd_congestion_fee"]
        + ["select 'cbd_congestion_fee', 'missing', 0",
           "select 'request_source', 'unexpected', count(store_and_fwd_flag) from raw"]
    ),
    "typed_trips": f"select {_doubles(_TYPED)} from typed",
    "unknown_member_lookup": """
        select trip_id, vendor_id, rate_code_id, pickup_location_id, dropoff_location_id, payment_type_id
        from standardized""",
    "standardized_trips": f"select {_doubles(_STANDARDIZED)} from standardized",
    "imputation_list": "select trip_id, dq_imputations from standardized",
    "dedup_first": "select trip_id, _source_file, _file_row_number, dq_duplicate from flagged",
    "quality_flags": f"select trip_id, {', '.join('dq_' + r.lower() for r in REASONS)} from flagged",
    "rejection_reason": "select trip_id, rejection_reason, dq_issues, is_valid from judged",
    "judged_trips": f"select {_doubles(EVALUATED_COLUMNS)} from judged",
    "valid_trips": f"select {_doubles(VALID_COLUMNS)} from valid",
    "rejected_trips": f"select {_doubles(REJECTED_COLUMNS)} from judged where not is_valid",
    "quality_summary": f"""
        select _source_period as source_period, count(*) as total_records,
          count(*) filter (where is_valid) as valid_records, count(*) filter (where not is_valid) as rejected_records,
          cast({_half_up('10000 * count(*) filter (where is_valid)', 'count(*)')} as double) / 100 as pct_valid,
          {', '.join(f"count(*) filter (where rejection_reason = '{r}') as rejected_{r.lower()}" for r in REASONS)},
          count(dq_imputations) as records_with_imputations,
          count(*) - count(passenger_count) as passenger_count_unknown
        from judged group by 1""",
    "zones_clean": "select * from zones_clean",
    "dim_date": _used("from calendar", "date_key", ("pickup_date_key", "pickups")),
    "dim_time": _used("from hours", "time_key", ("pickup_time_key", "pickups")),
    "dim_zone": _used(f"select {_key('location_id')} as zone_key, * from zones_clean", "zone_key",
                      ("pickup_zone_key", "pickups"), ("dropoff_zone_key", "dropoffs")),
    "dim_vendor": _used(f"select {_key('vendor_id')} as vendor_key, * from vendors", "vendor_key",
                        ("vendor_key", "trips")),
    "dim_rate_code": _used(
        f"select {_key('rate_code_id')} as rate_code_key, *, rate_code_id in (2, 3) as is_airport_rate "
        "from rate_codes", "rate_code_key", ("rate_code_key", "trips")),
    "dim_payment_type": _used(
        f"select {_key('payment_type_id')} as payment_type_key, *, payment_type_id = 1 as is_card_payment "
        "from payment_types", "payment_type_key", ("payment_type_key", "trips")),
    "fct_trips": f"select {_doubles(_FACT)} from fact",
    "monthly_revenue": f"""
        select strftime(pickup_datetime, '%Y-%m') as year_month, count(*) as viajes,
          cast(sum(total_amount) as double) as ingreso_total_usd,
          cast({_half_up(_cents('total_amount'), 'count(*)')} as double) / 100 as ticket_promedio_usd
        from valid group by 1 order by 1""",
    "demand_by_day_part": """
        select day_name, day_part, count(*) as viajes
        from valid join calendar on cast(pickup_datetime as date) = full_date
        join hours on hour(pickup_datetime) = time_key
        group by day_of_week, day_name, day_part order by day_of_week, day_part""",
    "top_routes": f"""
        select p.zone_name as zona_recogida, d.zone_name as zona_destino, count(*) as viajes,
          cast({_half_up(_cents('trip_distance_miles'), 'count(trip_distance_miles)')} as double) / 100
            as distancia_promedio_millas
        from valid join zones_clean p on p.location_id = pickup_location_id
        join zones_clean d on d.location_id = dropoff_location_id
        group by 1, 2 order by 3 desc, 1, 2 limit 10""",
    "tip_pct_by_payment": f"""
        select payment_type_description, count(*) as viajes,
          cast({_half_up('10000 * ' + _cents('tip_amount'), _cents('fare_amount'))} as double) / 100 as propina_pct
        from valid join payment_types using (payment_type_id) group by 1 order by 2 desc, 1""",
    "surcharge_by_month": """
        select strftime(pickup_datetime, '%Y-%m') as year_month,
          cast(sum(cbd_congestion_fee_amount) as double) as cargo_cbd_usd,
          count(nullif(cbd_congestion_fee_amount, 0)) as viajes_con_cargo
        from valid group by 1 order by 1""",
    "check_not_null": _checks(
        "raw.trips", "raw",
        *[("not_null", c, f"{c} is null") for c in (*TRIP_COLUMNS, "_source_file", "_file_row_number", "_loaded_at")]
    ),
    "check_unique": f"""
        select 'unique' as "check", 'bronze.trips' as "table", '_record_id' as "column", count(*) as failures
        from raw where {_file_of(6)}
        union all
        select 'unique', 'bronze.trips', 'tpep_pickup_datetime', count(*) from (
          select tpep_pickup_datetime from raw where tpep_pickup_datetime is not null group by 1
          having count(*) > 1 or bool_or({_file_of(6)}))""",
    "check_relationships": _checks(
        "silver.typed", "typed",
        *[("relationships", f"{c}_reported", f"{c}_reported is not null and {c}_reported not in (select {k} from {t})")
          for c, t, k in (("vendor_id", "vendors", "vendor_id"), ("rate_code_id", "rate_codes", "rate_code_id"),
                          ("pickup_location_id", "zones", "locationid"),
                          ("dropoff_location_id", "zones", "locationid"),
                          ("payment_type_id", "payment_types", "payment_type_id"))]
    ),
    "check_accepted_values": _checks(
        "silver.standardized", "judged",
        ("accepted_values", "rejection_reason", "rejection_reason = 'EMPTY_TRIP'"),
        ("accepted_values", "store_and_fwd_flag_reported", "store_and_fwd_flag_reported <> 'Y'"),
    ),
    "check_accepted_range": _checks(
        "silver.standardized", "standardized",
        ("accepted_range", "passenger_count_reported", "passenger_count_reported < 1 or passenger_count_reported > 6"),
        ("accepted_range", "trip_distance_miles", "trip_distance_miles < 0 or trip_distance_miles > 200"),
    ),
    "check_expression": _checks(
        "silver.standardized", "standardized",
        ("expression_is_true", "dropoff_datetime > pickup_datetime", "dropoff_datetime <= pickup_datetime"),
        ("expression_is_true", "total_amount >= 0 and fare_amount >= 0", "total_amount < 0 or fare_amount < 0"),
    ),
    "reconcile_counts": _mismatch(
        f"(select _source_file from raw where not ({_file_of(3)}))",
        f"""(select _source_file from raw where not ({_file_of(2)})
              and (payment_type is not null or not ({_file_of(1)})))""",
        "raw_rows", "bronze_rows"),
    "reconcile_amounts": f"""
        select a._source_file as source_file, a.n as silver_trips, b.n as gold_trips,
          cast(a.t as double) as silver_total, cast(b.t as double) as gold_total
        from (select _source_file, count(*) as n, sum(total_amount) as t from valid group by 1) a
        left join (select _source_file, count(*) as n, sum(total_amount) + if({_file_of(4)}, count(*), 0) as t
                   from fact where not ({_file_of(5)}) group by 1) b on a._source_file = b._source_file
        where a.n is distinct from b.n or a.t is distinct from b.t""",
    "standardized_keeps_all": _mismatch(
        "raw", "(select _source_file from standardized where pickup_datetime is not null)",
        "bronze_rows", "silver_rows"),
    "duplicate_business_keys": """
        select vendor_id, pickup_datetime, dropoff_datetime, pickup_location_id, dropoff_location_id,
          cast(trip_distance_miles as double) as trip_distance_miles, cast(fare_amount as double) as fare_amount,
          cast(total_amount as double) as total_amount, count(*) as copias
        from standardized group by all having copias > 1""",
    "missing_files": f"""
        select source_file from ledger where status = 'LOADED' and not exists (
          select 1 from valid v where suffix(v._source_file, ledger.source_file) and not ({_file_of(2)}))""",
    "ledger_vs_rows": _LEDGER_MISMATCHES,
    "expected_months_missing": "select * from expected where source_file not in (select source_file from inventory)",
    "changed_files": """
        select _source_file, count(*) as row_count from raw where _source_file in (
          select _source_file from raw where _loaded_at > (
            select max(_loaded_at) from raw where _source_file < 'yellow/yellow_tripdata_2000'))
        group by 1""",
    "load_plan": "select * from plan",
    "load_summary": """
        select count(*) filter (where status = 'LOADED') as months_loaded,
          count(*) filter (where status = 'SKIPPED') as months_unchanged,
          count(*) filter (where status = 'NOT_AVAILABLE') as months_not_available,
          count(*) filter (where status = 'FAILED') as months_failed,
          string_agg(strftime(source_period, '%Y-%m'), ',' order by source_period)
            filter (where status = 'NOT_AVAILABLE') as missing_months,
          cast(sum(rows) filter (where status in ('LOADED', 'SKIPPED')) as bigint) as raw_rows
        from results""",
    "ledger_upsert": """
        select e.*, cast(ifnull(l.attempts, 0) + 1 as bigint) as attempts
        from entries e left join ledger l using (source_file)
        union all by name
        select * from ledger where source_file not in (select source_file from entries)""",
    "incremental_replace": _RELOADED.format(source="raw"),
    "landed_scan": f"""
        select _source_file, row_number() over (partition by _source_file order by _file_row_number) as _file_row_number,
          {', '.join(c for c in TRIP_COLUMNS if c != 'cbd_congestion_fee')},
          if(_source_file >= 'yellow/yellow_tripdata_1995', cbd_congestion_fee, null) as cbd_congestion_fee
        from raw""",
    "landed_inventory": """
        select source_file, case m when 3 then 'resized' when 11 then 'new' when 12 then 'missing' else 'same' end as state
        from files""",
    "load_outcomes": """
        select e.source_file, e.source_period,
          case when f.n is null then 'NOT_AVAILABLE' when m = 6 then 'FAILED' else 'LOADED' end as status,
          if(m = 6, null, f.n) as file_rows, if(m = 6, null, f.n) as rows_loaded,
          if(f.n is null or m in (3, 6), 2, 1) as attempts,
          case when f.n is null then 'not published yet' when m <> 6 then 'ok' end as message,
          f.n is null or m in (3, 6) as in_last_run, f.n as rows_now, t + if(m = 3, f.n, 0) as total_now, f.n as last_row
        from expected e left join files f using (source_file) left join (
          select _source_file as path, cast(sum(cast(total_amount as decimal(18,2))) as double) as t from raw group by 1
        ) totals using (path)
        where e.source_period <= (select max(source_period) + interval 2 months from files)""",
    "code_tables_from_csv": _used(f"select {_key('vendor_id')} as vendor_key, * from vendors", "vendor_key",
                                  ("vendor_key", "trips")),
    "stored_schema_growth": """
        select _source_file, _file_row_number, vendorid, pulocationid,
          if(_source_file >= 'yellow/yellow_tripdata_1995', cbd_congestion_fee, null) as cbd_congestion_fee
        from raw""",
    "arrived_files": f"select {_doubles(_FACT[:-1])}, if({_file_of(1, 2, 3, 4, 5, 6)}, 1, 2) as arrival from fact",
    "compacted_loads": """
        select path as source_file, if(m = 6, 0, n) as row_count, if(m <> 6, t + if(m = 3, 2 * n, 0), null) as total,
          1 as listed, if(m = 6, 0, 1) as folders
        from files left join (
          select _source_file as path, cast(sum(cast(total_amount as decimal(18,2))) as double) as t from raw group by 1
        ) totals using (path)""",
    "check_all_layers": _all_checks(),
    "gated_layers": f"""
        select 'silver' as layer, * , 'bronze,silver' as built from (
          select 'not_null' as "check", 'silver.valid' as "table", 'trip_distance_miles' as "column", count(*) as failures
          from valid where trip_distance_miles is null
          union all
          select 'reconciliation', 'silver', 'no repeated trips', count(*) from {_REPEATED_TRIPS})
        where failures > 0""",
    "ledger_vs_rows_theta": _LEDGER_MISMATCHES,
    "ledger_vs_rows_long_list": _LEDGER_MISMATCHES,
    "first_run_files": "select _source_file, count(*) as row_count from raw group by 1",
    "layered_reload": f"select {_doubles(_FACT)} from fact",
    "layered_full_refresh": f"select {_doubles(_FACT)} from fact",
}

#: Steps that differ in one query.
OTHER_STEPS = {
    "gated_layers": {"raw": f"select * replace (if({_file_of(2)}, null, trip_distance) as trip_distance) from ({CTES['raw']})"},
    "code_tables_from_csv": {
        "vendors": f"select * from (values {_values([v for v in VENDORS if v[0] != 6])}) v(vendor_id, vendor_name)"
    },
    "layered_reload": {"landed": CTES["raw"], "raw": _RELOADED.format(source="landed")},
    "arrived_files": {"landed": CTES["raw"], "raw": """
        select * replace (row_number() over (partition by _source_file order by _file_row_number) as _file_row_number,
          if(_source_file >= 'yellow/yellow_tripdata_1995', cbd_congestion_fee, null) as cbd_congestion_fee)
        from landed"""},
    "layered_full_refresh": {"flagged": CTES["flagged"].replace("not between 0 and 200", "not between 0 and 100")},
}


def oracle_sql() -> dict[str, str]:
    found = {}
    for name, select in QUERIES.items():
        changed = OTHER_STEPS.get(name, {})
        steps = {}
        for step, text in CTES.items():
            if step == "raw" and "landed" in changed:
                steps["landed"] = changed["landed"]
            steps[step] = changed.get(step, text)
        found[name] = _query(select, steps)
    return found
