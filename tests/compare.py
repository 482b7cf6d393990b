"""Compare every registered query with its SQL counterpart: ``python tests/compare.py <data folder> [query ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if hasattr(value, "as_tuple"):
        return round(float(value), 6)
    return value


def rows_of(columns, rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def difference(spark_df, con, sql: str) -> str | None:
    """None when names, number of rows and all values agree."""
    ours = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    result = con.execute(sql)
    theirs = rows_of([d[0] for d in result.description], result.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {set(ours[0]) ^ set(theirs[0])}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} rows, expected {len(theirs[1])}"
    for a, b in zip(ours[1], theirs[1], strict=True):
        if a != b:
            wrong = [(n, x, y) for n, x, y in zip(ours[0], a, b, strict=True) if x != y]
            return f"values {wrong[:6]}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from farestrata import session

    folder, *names = sys.argv[1:]
    spark = session.build(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = duck(folder), entry.oracle_sql()
    bad = 0
    for name, build in entry.queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            df = build(spark, folder)
            found = difference(df, con, sql[name]) if name in sql else f"no SQL; {df.count()} rows"
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:600]}"
        bad += found is not None
        print(f"{name:28} {time.time() - started:6.2f}s  {found or 'ok'}", flush=True)
    print(f"{bad} differences")
    sys.exit(bad > 0)
