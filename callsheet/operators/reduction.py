"""Leaving rows whose account was not asked for out of the shuffles.

A run for some portfolios needs the phones and the history of their accounts
only, but those tables carry no portfolio.  The accounts' ids are hashed into
a bitmap of a fixed size, which is broadcast and looked up next to the scan,
before anything is de-duplicated, ranked or exchanged.  An id whose bit
another one set gets through and is dropped by the join that follows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the bitmap, 16 MB, and of one of its rows, 4 KB: what is broadcast never grows beyond that.
BITS, ROW_BITS = 1 << 27, 1 << 15


def _place(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BITS))


def key_bitmap(keys: DataFrame, key: str) -> DataFrame:
    """(_row, _bits): the bitmap of a column, ``BITS / ROW_BITS`` rows at most; built map-side first."""
    place = _place(F.col(key))
    row, bit = F.floor(place / ROW_BITS).cast("int"), place % ROW_BITS
    return keys.select(row.alias("_row"), bit.alias("_bit")).groupBy("_row").agg(F.bitmap_construct_agg("_bit").alias("_bits"))


def held(rows: DataFrame, bitmap: DataFrame, key: str) -> DataFrame:
    """The rows whose key the bitmap may hold; columns and order stay, a null key is a key."""
    row, bits = bitmap["_row"], bitmap["_bits"]
    bit = _place(rows[key]) % ROW_BITS
    byte = F.conv(F.hex(F.substring(bits, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    found = rows.join(F.broadcast(bitmap), F.floor(_place(rows[key]) / ROW_BITS).cast("int") == row)
    return found.filter(F.bit_get(byte, (bit % 8).cast("int")) == 1).select(*[rows[c] for c in rows.columns])
