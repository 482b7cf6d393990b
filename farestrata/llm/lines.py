"""Lines that several documents share are dropped everywhere but in the first document, by two Bloom filters.

A line's key is the line without spaces at its ends and with A-Z lower-cased; keys of fewer than ``MIN_CHARS`` code points
are never looked at. A first pass enters each document's distinct keys into two filters: one holds the hashes seen
once, the other those met again. Filters of tasks unite without a loss: a hash that two tasks saw has all its
cells in both, so the cells that both have set go to the second filter. The second pass sends only keys that the second filter
holds through the shuffle, as SHA-256 digests. There they are counted exactly, so strangers that passed the filter change
nothing, and the smallest id that has a key is chosen. Filters have 16 cells per line of the table, up to
``bloom.MOST_BITS`` cells (128 MiB); beyond that more strangers pass and are sorted out exactly.

The first occurrence is the smallest id; all lines of that document stay, repeats too. NULL ids come after all others
and count as one document. Rows that repeat an id are one document as far as first occurrences go. NULL and empty texts
are one empty line. Rows that repeat id and text get the same answer. An empty table gives an empty result; other
columns are ignored. Memory per task: the filters, one batch, and about 100 bytes per line of the longest text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farestrata.llm import bloom
from farestrata.llm.common import map_arrow, stored

MIN_CHARS = 10
SPACES = b" \t\n\x0b\x0c\r"
#: Bytes from which a line has at least ``MIN_CHARS`` code points for certain.
SURELY = 4 * MIN_CHARS


def line_keys(text: str | None) -> Iterator[tuple[int, bytes]]:
    """Position and key of every line that is long enough."""
    for at, line in enumerate((text or "").encode().lower().split(b"\n")):
        key = line.strip(SPACES)
        if len(key) >= SURELY or len(key) >= MIN_CHARS and len(key.decode()) >= MIN_CHARS:
            yield at, key


def _hashes(keys) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(key) for key in keys), np.uint64)


def enter(hashes: np.ndarray, once: np.ndarray, twice: np.ndarray) -> None:
    """Enter hashes, one per document and key: those met before go to the second filter, all to the first."""
    distinct, times = np.unique(hashes, return_counts=True)
    places = bloom.cells(distinct, 8 * len(once))
    bloom.put(twice, places[(times > 1) | bloom.holds(once, places)])
    bloom.put(once, places)


def unite(left: list[np.ndarray], right: list[np.ndarray]) -> list[np.ndarray]:
    (once, twice), (more, again) = left, right
    return [once | more, twice | again | once & more]


def seen_twice(docs: DataFrame, text_col: str, size: int) -> np.ndarray:
    """The second filter over all documents."""
    def run(batches) -> Iterator[tuple[list, ...]]:
        once, twice = bloom.empty(size), bloom.empty(size)
        for batch in batches:
            own = [np.unique(_hashes(key for _, key in line_keys(text.as_py()))) for text in batch.column(0)]
            enter(np.concatenate(own), once, twice)
        yield from bloom.segments(once, twice)

    touched = map_arrow(docs.select(text_col), run, "segment int, once binary, twice binary")
    return bloom.united(touched, unite, size)[1]


def suspects(docs: DataFrame, twice: np.ndarray) -> DataFrame:
    """``id, text_md5, line_key, positions`` of the keys that the second filter holds; ``docs`` has ``id, text``."""
    shipped = docs.sparkSession.sparkContext.broadcast(twice)
    kind = dict(docs.dtypes)["id"]

    def run(batches) -> Iterator[tuple]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            rows, places, keys = [], [], []
            for row, text in enumerate(texts):
                for at, key in line_keys(text):
                    rows.append(row)
                    places.append(at)
                    keys.append(key)
            if not keys:
                continue
            held = bloom.holds(shipped.value, bloom.cells(_hashes(keys), 8 * len(shipped.value)))
            found: dict[tuple[int, bytes], list[int]] = {}
            for i in np.flatnonzero(held):
                found.setdefault((rows[i], keys[i]), []).append(places[i])
            digests = {row: hashlib.md5(texts[row].encode()).hexdigest() for row, _ in found}
            yield (
                batch.column(0).take(pa.array([row for row, _ in found], pa.int32())),
                [digests[row] for row, _ in found],
                [hashlib.sha256(key).digest() for _, key in found],
                list(found.values()),
            )

    return map_arrow(docs, run, f"id {kind}, text_md5 string, line_key binary, positions array<int>")


def _rank(id_col: str) -> Column:
    """Orders ids, NULL last."""
    return F.struct(F.col(id_col).isNull().alias("missing"), F.col(id_col).alias("id"))


def repeated_lines(docs: DataFrame) -> DataFrame:
    """``id, text_md5, positions``: the lines to drop, one row per document that loses any; ``docs`` has ``id, text``."""
    breaks = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))
    lines = docs.agg(F.sum(F.coalesce(breaks, F.lit(0)) + 1)).first()[0] or 0
    found = stored(suspects(docs, seen_twice(docs, "text", bloom.size_for(lines))), "line-suspects")
    firsts = stored(
        found.groupBy("line_key").agg(F.min(_rank("id")).alias("first"), F.max(_rank("id")).alias("last"))
        .where("first != last").select("line_key", "first"),
        "line-firsts",
    )
    # both sides come from storage, so Spark can split a line that very many documents share
    late = found.join(firsts, "line_key").where(_rank("id") > F.col("first"))
    return late.groupBy("id", "text_md5").agg(F.flatten(F.collect_set("positions")).alias("positions"))


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_lines, n_dropped, text`` for every row: lines before, lines dropped, and the lines that stay."""
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    lost = stored(repeated_lines(rows), "line-drops").select(
        F.col("id").alias("lost_id"), F.col("text_md5").alias("lost_md5"), "positions"
    )
    marked = rows.withColumn("text_md5", F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    joined = marked.join(lost, F.col("id").eqNullSafe(F.col("lost_id")) & (F.col("text_md5") == F.col("lost_md5")), "left")

    def run(batches) -> Iterator[tuple]:
        for batch in batches:
            counts, dropped, texts = [], [], []
            for text, positions in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                lines = (text or "").split("\n")
                gone = set(positions or ())
                counts.append(len(lines))
                dropped.append(len(gone))
                texts.append("\n".join(line for at, line in enumerate(lines) if at not in gone))
            yield batch.column(0), counts, dropped, texts

    schema = f"`{id_col}` {kind}, n_lines bigint, n_dropped bigint, text string"
    return map_arrow(joined.select("id", "text", "positions"), run, schema)
