"""Joins of rows to a table with one row per key, when a key may be hot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tables that Catalyst knows to be no larger may be broadcast.
SMALL_BYTES = 8 << 20


def split_join(rows: DataFrame, per_key: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``rows`` joined to ``per_key`` (an aggregate, one row per key) on
    ``keys``, so that AQE can split a hot key.

    AQE splits a join partition only where both sides come straight from an
    exchange, and an aggregate's final step would stand between.  A hash of
    the keys as one more join key asks for an exchange of the finished
    aggregate, which is small: one row per key.  At run time a partition that
    one key fills is then read by several tasks, each with the key's one row.
    Keys that are not hot cost nothing more, and the result is the plain join's.
    """
    name = F.xxhash64(*keys).alias("_key_hash")
    return rows.select("*", name).join(per_key.select("*", name), [*keys, "_key_hash"], how).drop("_key_hash")


def known_bytes(df: DataFrame) -> int:
    """Catalyst's size of ``df``: exact file sizes for a stored table, and an upper bound after filters."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, limit: int = SMALL_BYTES) -> DataFrame:
    """``df``, marked for broadcasting if its size is known to be at most ``limit``; else a plain join side."""
    return F.broadcast(df) if known_bytes(df) <= limit else df
