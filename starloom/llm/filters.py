"""Tables of a fixed number of buckets, counted over all rows, for use inside tasks.

Each task adds up its own rows and sends the table in chunks; the chunks are added up in a
second step, and only the sum comes to the driver. Its size is a parameter and does not grow
with the data. Buckets that share rows only weaken a filter; they never make it wrong.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from starloom.llm.shingles import mixed

CHUNK = 4096
SCHEMA = "chunk int, counts binary"
DROP_BITS = 23


def _chunks(total: np.ndarray) -> Iterator[pa.RecordBatch]:
    parts = total.reshape(-1, min(CHUNK, len(total)))
    at = np.flatnonzero(parts.any(axis=1))
    if len(at):
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int32()), pa.array([parts[i].tobytes() for i in at], pa.binary())],
            ["chunk", "counts"],
        )


def _combined(tables: DataFrame, combine, kind, size: int) -> np.ndarray:
    """The chunks of all tasks combined, first in tasks and then as one array on the driver."""
    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(counts, kind)
                total[chunk] = combine(total[chunk], part) if chunk in total else part
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.int32()),
                 pa.array([x.tobytes() for x in total.values()], pa.binary())],
                ["chunk", "counts"],
            )

    out = np.zeros(size, kind).reshape(-1, min(CHUNK, size))
    for chunk, counts in tables.repartition("chunk").mapInArrow(add, SCHEMA).toLocalIterator():
        out[chunk] = np.frombuffer(counts, kind)
    return out.ravel()


def bucket_counts(
    rows: DataFrame, buckets: Callable[[pa.RecordBatch], Iterator[np.ndarray]], bits: int
) -> np.ndarray:
    """How many of the numbers that `buckets` gives for the batches fall on each of 2^bits."""

    def count(batches):
        total = np.zeros(1 << bits, np.uint32)
        for batch in batches:
            for at in buckets(batch):
                total += np.bincount(at, minlength=1 << bits).astype(np.uint32)
        yield from _chunks(total)

    return _combined(rows.mapInArrow(count, SCHEMA), np.add, np.uint32, 1 << bits)


def bucket_of(keys: np.ndarray, bits: int) -> np.ndarray:
    return (mixed(keys.astype(np.int64).view(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)


def key_filter(keys: DataFrame, bits: int = DROP_BITS) -> np.ndarray:
    """Which buckets hold a key of this one-column table of longs: one bit each."""

    def mark(batches):
        held = np.zeros(1 << bits, bool)
        for batch in batches:
            held[bucket_of(pc.drop_null(batch.column(0)).to_numpy(zero_copy_only=False), bits)] = True
        yield from _chunks(np.packbits(held))

    return _combined(keys.mapInArrow(mark, SCHEMA), np.bitwise_or, np.uint8, 1 << bits - 3)


def in_filter(held: np.ndarray, keys: np.ndarray, bits: int = DROP_BITS) -> np.ndarray:
    at = bucket_of(keys, bits)
    return ((held[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).astype(bool)


def split_by_filter(rows: DataFrame, key: str, held: np.ndarray, bits: int = DROP_BITS):
    """(rows whose key may be held, rows whose key is not), without moving rows."""
    shared = rows.sparkSession.sparkContext.broadcast(held)

    def part(wanted: bool):
        def choose(batches):
            for batch in batches:
                keys = batch.column(batch.schema.get_field_index(key))
                numbers = pc.fill_null(keys, 0).to_numpy(zero_copy_only=False)
                hit = in_filter(shared.value, numbers, bits) & pc.is_valid(keys).to_numpy(zero_copy_only=False)
                yield batch.filter(pa.array(hit if wanted else ~hit))

        return rows.mapInArrow(choose, rows.schema)

    return part(True), part(False)


def without(rows: DataFrame, key: str, dropped: DataFrame) -> DataFrame:
    """Rows whose key (a long) is not in `dropped`; only rows that may be in it are shuffled.

    Rows without a key stay.
    """
    maybe, clear = split_by_filter(rows, key, key_filter(dropped.select(key)))
    return clear.unionByName(maybe.join(dropped.select(key).distinct(), key, "left_anti"))
