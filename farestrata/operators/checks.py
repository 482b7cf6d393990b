"""Data checks. Every check counts the rows or values that break it; zero means it holds.

Result schema: ``check, table, column, failures``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farestrata.functions import base_name
from farestrata.operators.dedup import suspects


@dataclass(frozen=True)
class Relationship:
    column: str
    table: str
    key: str


@dataclass(frozen=True)
class TableChecks:
    """Checks declared for one table."""

    table: str
    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    relationships: Sequence[Relationship] = ()
    accepted_values: dict[str, Sequence[str]] = field(default_factory=dict)
    accepted_range: dict[str, tuple[float, float]] = field(default_factory=dict)
    expressions: Sequence[str] = ()

    def count(self) -> int:
        return sum(len(getattr(self, kind)) for kind in (
            "not_null", "unique", "relationships", "accepted_values", "accepted_range", "expressions"
        ))


def _result(check: str, table: str, column: str, failures: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check"),
        F.lit(table).alias("table"),
        F.lit(column).alias("column"),
        failures.cast("bigint").alias("failures"),
    )


def row_checks(df: DataFrame, spec: TableChecks) -> DataFrame | None:
    """All checks that look at one row at a time, in a single pass.

    NULL passes every one of them except ``not_null``.
    """
    broken = [("not_null", c, F.col(c).isNull()) for c in spec.not_null]
    broken += [("accepted_values", c, ~F.col(c).isin(*vs)) for c, vs in spec.accepted_values.items()]
    broken += [("accepted_range", c, ~F.col(c).between(*ends)) for c, ends in spec.accepted_range.items()]
    broken += [("expression_is_true", e, ~F.expr(e)) for e in spec.expressions]
    if not broken:
        return None
    results = [_result(check, spec.table, column, F.count_if(bad)) for check, column, bad in broken]
    return df.agg(F.array(*results).alias("results")).select(F.inline("results"))


def _values(df: DataFrame, typed: Sequence[tuple[str, str]]) -> tuple[DataFrame, list[str]]:
    """One row per non-NULL value of the given columns, each read as its type, from one scan.

    A row holds the position of the column in ``typed`` and one field per type, filled where that is its type.
    Also returns the names of these key fields.
    """
    kinds = {kind: f"as_{i}" for i, kind in enumerate(dict.fromkeys(kind for _, kind in typed))}
    entries = [
        F.struct(F.lit(i).alias("position"), *[
            (F.col(c) if kind == own else F.lit(None)).cast(kind).alias(name) for kind, name in kinds.items()
        ])
        for i, (c, own) in enumerate(typed)
    ]
    values = df.select(F.inline(F.array(*entries))).where(
        reduce(lambda a, b: a | b, [F.col(n).isNotNull() for n in kinds.values()])
    )
    return values, ["position", *kinds.values()]


def _compared_as(child: DataFrame, column: str, parent: DataFrame, key: str) -> str:
    """The type in which a key is compared with its parent: the wider one of both; text if one of them is text."""
    own = child.select(F.col(column).alias("k"))
    other = parent.select(F.col(key).alias("k"))
    types = {own.dtypes[0][1], other.dtypes[0][1]}
    if len(types) == 1:
        return types.pop()
    return "string" if "string" in types else own.union(other).dtypes[0][1]


def unique_checks(df: DataFrame, spec: TableChecks, stored: bool = False) -> DataFrame | None:
    """Per column, the number of values that occur more than once; NULL is not a value.

    A large ``stored`` table is read twice: once for hashes, then for the values that may be repeated, so few values cross the network.
    """
    if not spec.unique:
        return None
    values, fields = _values(df, [(c, df.select(c).dtypes[0][1]) for c in spec.unique])
    values = suspects(values, fields) if stored else values
    repeated = values.groupBy(*fields).agg(F.count("*").alias("n")).where("n > 1")
    results = [_result("unique", spec.table, c, F.count_if(F.col("position") == i)) for i, c in enumerate(spec.unique)]
    return repeated.agg(F.array(*results).alias("results")).select(F.inline("results"))


def relationship_checks(df: DataFrame, spec: TableChecks, parents: dict[str, DataFrame]) -> DataFrame | None:
    """Per foreign key, the number of rows whose non-NULL key has no parent.

    Rows are counted per key first, so a key held by many rows crosses the network once per task. Keys are compared in
    the wider type of both sides: 1.0 finds the parent 1, 1.5 doesn't.
    """
    if not spec.relationships:
        return None
    typed = [(r.column, _compared_as(df, r.column, parents[r.table], r.key)) for r in spec.relationships]
    values, fields = _values(df, typed)
    counted = values.groupBy(*fields).agg(F.count("*").alias("n"))
    kinds = dict.fromkeys(kind for _, kind in typed)
    keys = reduce(DataFrame.union, [
        parents[r.table].select(F.lit(i).alias("position"), *[
            (F.col(r.key) if kind == own else F.lit(None)).cast(kind).alias(f"parent_{name}")
            for kind, name in zip(kinds, fields[1:], strict=True)
        ])
        for i, (r, (_, own)) in enumerate(zip(spec.relationships, typed, strict=True))
    ]).withColumnRenamed("position", "parent_position")
    same = reduce(lambda a, b: a & b, [F.col(f).eqNullSafe(F.col(f"parent_{f}")) for f in fields])
    orphans = counted.join(keys, same, "left_anti")
    results = [
        _result("relationships", spec.table, r.column,
                F.coalesce(F.sum(F.when(F.col("position") == i, F.col("n"))), F.lit(0)))
        for i, r in enumerate(spec.relationships)
    ]
    return orphans.agg(F.array(*results).alias("results")).select(F.inline("results"))


def run_checks(
    df: DataFrame, spec: TableChecks, parents: dict[str, DataFrame] | None = None, stored: bool = False
) -> DataFrame:
    """All checks of a table in at most three scans of the columns they name; one more if ``stored``, for :func:`unique_checks`."""
    parts = [row_checks(df, spec), unique_checks(df, spec, stored), relationship_checks(df, spec, parents or {})]
    return reduce(DataFrame.union, [p for p in parts if p is not None])


# --- reconciliation between tables ------------------------------------------------------------------------


def _per_file(df: DataFrame, **measures: Column) -> DataFrame:
    return df.groupBy("_source_file").agg(*[m.alias(name) for name, m in measures.items()])


def _differs(left: str, right: str) -> Column:
    return F.coalesce(left, F.lit(-1)) != F.coalesce(right, F.lit(-1))


def count_mismatches(left: DataFrame, right: DataFrame, left_name: str, right_name: str) -> DataFrame:
    """Files whose number of rows is not the same in both tables."""
    a = _per_file(left, **{left_name: F.count("*")})
    b = _per_file(right, **{right_name: F.count("*")})
    return (
        a.join(b, "_source_file", "full_outer")
        .where(_differs(left_name, right_name))
        .withColumnRenamed("_source_file", "source_file")
    )


def amount_mismatches(valid: DataFrame, fact: DataFrame) -> DataFrame:
    """Files whose trips or total amount differ between the valid trips and the fact."""
    a = _per_file(valid, silver_trips=F.count("*"), silver_total=F.sum("total_amount"))
    b = _per_file(fact, gold_trips=F.sum("trip_count"), gold_total=F.sum("total_amount"))
    return (
        a.join(b, "_source_file", "full_outer")
        .where(_differs("silver_trips", "gold_trips") | _differs("silver_total", "gold_total"))
        .select(
            F.col("_source_file").alias("source_file"),
            "silver_trips",
            "gold_trips",
            "silver_total",
            "gold_total",
        )
    )


def loaded_files(ledger: DataFrame, dataset: str) -> DataFrame:
    return ledger.where((F.col("dataset") == dataset) & (F.col("status") == "LOADED"))


def ledger_mismatches(raw: DataFrame, ledger: DataFrame, dataset: str) -> DataFrame:
    """Loaded files whose rows are not the ones the ledger reports. A ledger row without a count is not judged.

    Ledger and table name a file with different folders, so both are joined on the last path segment.
    """
    rows = _per_file(raw, raw_rows=F.count("*")).select(base_name("_source_file").alias("_name"), "raw_rows")
    loaded = loaded_files(ledger, dataset).select(
        "source_file", "rows_loaded", base_name("source_file").alias("_name")
    )
    return (
        loaded.join(rows, "_name", "left")
        .where(F.coalesce("raw_rows", F.lit(-1)) != F.col("rows_loaded"))
        .select("source_file", "rows_loaded", "raw_rows")
    )


#: Loaded files up to which their list is broadcast.
MOST_BROADCAST_FILES = 100_000


def ledger_mismatches_by_suffix(
    raw: DataFrame, ledger: DataFrame, dataset: str, most_broadcast: int = MOST_BROADCAST_FILES
) -> DataFrame:
    """:func:`ledger_mismatches` with the condition as it is written: the table's file name ends in the ledger's.

    Rows are counted per file first, so both sides hold one row per file. The list of loaded files is counted and
    broadcast for a nested loop join while it is short. A longer one is joined by equality: each counted file offers its ending
    once per length that a name in the ledger has.
    """
    rows = _per_file(raw, raw_rows=F.count("*"))
    loaded = loaded_files(ledger, dataset).select("source_file", "rows_loaded")
    if loaded.limit(most_broadcast + 1).count() <= most_broadcast:
        ends = F.expr("right(_source_file, length(source_file)) = source_file")
        joined = F.broadcast(loaded).join(rows, ends, "inner")
    else:
        lengths = loaded.select(F.length("source_file").alias("_length")).distinct()
        endings = rows.join(lengths, F.length("_source_file") >= F.col("_length")).select(
            F.expr("right(_source_file, _length)").alias("source_file"), "raw_rows"
        )
        joined = loaded.join(endings, "source_file")
    found = joined.select("source_file", "raw_rows")
    return (
        loaded.join(found, "source_file", "left")
        .where(F.coalesce("raw_rows", F.lit(-1)) != F.col("rows_loaded"))
        .select("source_file", "rows_loaded", "raw_rows")
    )


def files_missing_from(fact: DataFrame, ledger: DataFrame, dataset: str) -> DataFrame:
    """Loaded files without a single trip in the fact."""
    present = fact.select("_source_file").distinct().select(base_name("_source_file").alias("_name"))
    loaded = loaded_files(ledger, dataset).select("source_file", base_name("source_file").alias("_name"))
    return loaded.join(present, "_name", "left_anti").select("source_file")


def repeated_business_keys(valid: DataFrame, keys: list[str], stored: bool = False) -> DataFrame:
    """Trips that occur more than once over all files; ``stored`` as in :func:`unique_checks`."""
    valid = suspects(valid.select(*keys), keys) if stored else valid
    return valid.groupBy(*keys).agg(F.count("*").alias("copias")).where("copias > 1")


def validity_mismatches(evaluated: DataFrame, valid: DataFrame) -> DataFrame:
    """Files whose valid table does not hold exactly the records judged valid, e.g. stale rows after a reload."""
    return count_mismatches(evaluated.where("is_valid"), valid, "judged_valid", "valid_rows")
