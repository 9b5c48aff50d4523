"""A bitmap of keys in front of a join.

The keys of the small side are hashed into a bitmap of fixed size, built and
tested by SQL functions; the large side is filtered by it during its scan, so
only rows that may match are shuffled.  The bitmap never misses a key; the more
keys it holds, the more others pass, and the join after it decides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.operators.load import _keys, insert_new

#: log2 of the bitmap's bits: 2**25 bits are 1,024 parts of 4 KB, 4 MB in all.
BITS = 25
_PART = 15                                               # 2**15 bits a part


def _slot(keys: Sequence[str], bits: int):
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(1 << bits))


def key_bitmap(df: DataFrame, key: str | Sequence[str], bits: int = BITS) -> DataFrame:
    """(part, bitmap) of the keys of ``df``: at most 2**bits / 8 bytes in rows of
    4 KB, whatever the number of keys.  Null keys are left out: they match
    nothing."""
    keys = _keys(key)
    slots = df.dropna(subset=keys).select(_slot(keys, bits).alias("_slot"))
    return slots.groupBy(F.shiftright("_slot", _PART).alias("_part")).agg(
        F.bitmap_construct_agg(F.pmod("_slot", F.lit(1 << _PART))).alias("_bitmap"))


def may_hold(df: DataFrame, bitmap: DataFrame, key: str | Sequence[str], bits: int = BITS) -> DataFrame:
    """The rows of ``df`` whose key may be among the bitmap's; broadcast, as its
    size is fixed."""
    slot = _slot(_keys(key), bits)
    bit = F.pmod(slot, F.lit(1 << _PART))
    byte = F.conv(F.hex(F.substring("_bitmap", F.shiftright(bit, 3).cast("int") + 1, F.lit(1))),
                  16, 10).cast("int")
    # shifting by a column has no function of its own: divide by the power of two
    held = F.pmod(F.floor(byte / F.pow(F.lit(2.0), F.pmod(bit, F.lit(8)))), F.lit(2)) == 1
    return df.join(F.broadcast(bitmap), F.shiftright(slot, _PART) == F.col("_part")).where(
        held).select(*df.columns)


def insert_new_filtered(stg: DataFrame, prod: DataFrame, key: str | Sequence[str],
                        bits: int = BITS) -> DataFrame:
    """J1 as ``insert_new``, with production's keys filtered by staging's bitmap
    before they are shuffled."""
    keys = _keys(key)
    near = may_hold(prod.select(*keys), key_bitmap(stg, keys, bits), keys, bits)
    return insert_new(stg, near, keys)
