"""A bitmap over a table's keys, small enough for every task.

Used to leave rows that cannot have a partner out of a shuffle.  It may let
through rows without one (the join or grouping that follows is exact), never
the reverse.  Its size follows the number of keys up to ``MAX_BITS`` (64 MB);
beyond that it only lets more rows through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from callsheet.llm.arrays import mix

MAX_BITS = 1 << 29
SEGMENTS = 64


def _places(keys: np.ndarray, bits: int) -> np.ndarray:
    """Two bit positions for each key."""
    h = mix(keys.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    mask = np.uint64(bits - 1)
    return np.stack([h & mask, (h >> np.uint64(32)) & mask]).astype(np.int64)


def key_filter(keys: DataFrame, bits_per_key: int = 16, max_bits: int = MAX_BITS) -> Broadcast:
    """The bitmap of the first column (long) of ``keys``, as a broadcast variable."""
    n = keys.count()
    bits = min(max_bits, max(1 << 16, 1 << (max(1, n * bits_per_key) - 1).bit_length()))
    part = bits // SEGMENTS

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = np.unique(_places(batch.column(0).drop_null().to_numpy(zero_copy_only=False), bits))
            yield pa.RecordBatch.from_arrays([pa.array((p // part).astype(np.int32)), pa.array((p % part).astype(np.int32))], names=["segment", "at"])

    def maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            segment, at = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for s in np.unique(segment).tolist():
                found.setdefault(s, np.zeros(part, bool))[at[segment == s]] = True
        for s, b in found.items():
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([np.packbits(b, bitorder="little").tobytes()], pa.binary())], names=["segment", "bits"])

    rows = keys.select(keys.columns[0]).mapInArrow(places, "segment int, at int").repartition("segment").mapInArrow(maps, "segment int, bits binary").collect()
    bitmap = np.zeros(bits // 8, np.uint8)
    for r in rows:  # SEGMENTS rows, MAX_BITS bits at most
        bitmap[r["segment"] * part // 8:(r["segment"] + 1) * part // 8] |= np.frombuffer(r["bits"], np.uint8)
    return keys.sparkSession.sparkContext.broadcast(bitmap)


def may_hold(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """For each key whether the table may hold it."""
    at = _places(keys, len(bitmap) * 8)
    hit = (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1
    return (hit[0] & hit[1]).astype(bool)
