"""Bloom filters over a whole table: set in tasks, united by segment, of a size that the driver and every task can hold.

A filter is cut into segments of 64 KiB. Tasks give the segments they touched, segments are united by shuffle, and only the
united ones, one row each, reach the driver. A filter never misses what was put in; with more entries than it was
made for it only lets more strangers pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame

from farestrata.llm.common import map_arrow

SEGMENT_BITS = 1 << 19
SEGMENT_BYTES = SEGMENT_BITS // 8
PROBES = 4
#: Cells per entry, and the bounds of a filter's size.
PER_ENTRY, LEAST_BITS, MOST_BITS = 16, 1 << 20, 1 << 30


def size_for(entries: int, least: int = LEAST_BITS, most: int = MOST_BITS) -> int:
    """Cells of a filter for so many entries: a power of two."""
    return min(max(1 << (max(entries, 1) * PER_ENTRY - 1).bit_length(), least), most)


def cells(hashes: np.ndarray, size: int) -> np.ndarray:
    """The cells of 64-bit hashes, one row of ``PROBES`` each."""
    first = hashes.astype(np.uint64)
    second = (first >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)
    steps = np.arange(PROBES, dtype=np.uint64)
    return ((first[:, None] + second[:, None] * steps) & np.uint64(size - 1)).astype(np.int64)


def empty(size: int) -> np.ndarray:
    return np.zeros(size // 8, np.uint8)


def put(bits: np.ndarray, places: np.ndarray) -> None:
    flat = places.ravel()
    np.bitwise_or.at(bits, flat >> 3, np.left_shift(1, flat & 7).astype(np.uint8))


def holds(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    return ((bits[places >> 3] >> (places & 7).astype(np.uint8)) & 1).all(axis=1)


def segments(*filters: np.ndarray) -> Iterator[tuple[list, ...]]:
    """``segment`` and its bytes in each of the filters, which are alike in size, for the segments that the first has cells in."""
    parts = [bits.reshape(-1, SEGMENT_BYTES) for bits in filters]
    for at in np.flatnonzero(parts[0].any(axis=1)):
        yield [int(at)], *([part[at].tobytes()] for part in parts)


def united(touched: DataFrame, fold: Callable[[list[np.ndarray], list[np.ndarray]], list[np.ndarray]], size: int) -> list[np.ndarray]:
    """The filters as a whole, from the rows that :func:`segments` gave in the tasks."""
    names = touched.columns[1:]

    def run(batches) -> Iterator[tuple[list, ...]]:
        kept: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            columns = [column.to_pylist() for column in batch.columns]
            for at, *parts in zip(*columns, strict=True):
                own = [np.frombuffer(part, np.uint8) for part in parts]
                kept[at] = fold(kept[at], own) if at in kept else own
        for at, parts in kept.items():
            yield [at], *([part.tobytes()] for part in parts)

    schema = "segment int, " + ", ".join(f"{name} binary" for name in names)
    whole = [empty(size) for _ in names]
    # one row per segment: bounded by the size of the filter
    for row in map_arrow(touched.repartition("segment"), run, schema).collect():
        start = row.segment * SEGMENT_BYTES
        for bits, part in zip(whole, row[1:], strict=True):
            bits[start:start + SEGMENT_BYTES] = np.frombuffer(bytes(part), np.uint8)
    return whole
