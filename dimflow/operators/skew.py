"""Lookups on hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot with this share of all rows, so there are at most 1 / HOT keys.
HOT = 0.01
SALT = 32


def hot_keys(df: DataFrame, key: str, share: float = HOT) -> DataFrame:
    """(key): those with at least ``share`` of the rows of ``df``, at most
    1 / share of them.  Counts are added up before they are shuffled; the number
    of rows is asked for first."""
    least = share * df.count()
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least).select(key)


def salted_lookup(stg: DataFrame, lookup: DataFrame, stg_key: str, lookup_key: str,
                  share: float = HOT, salt: int = SALT) -> DataFrame:
    """J2's inner join where a few keys may hold most of ``stg``: rows of hot
    keys are dealt over ``salt`` parts by their other columns, and only the
    lookup rows of hot keys are repeated, once a part.  All columns of both sides
    (names must differ) come back; the result is that of the plain join."""
    hot = F.broadcast(hot_keys(stg, stg_key, share).select(F.col(stg_key).alias("_hot")))
    part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in stg.columns]), F.lit(salt)).cast("int")
    left = stg.join(hot, F.col(stg_key) == F.col("_hot"), "left").withColumn(
        "_salt", F.when(F.col("_hot").isNotNull(), part).otherwise(0)).drop("_hot")
    right = lookup.join(hot, F.col(lookup_key) == F.col("_hot"), "left").withColumn(
        "_part", F.explode(F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.lit(salt - 1)))
                           .otherwise(F.array(F.lit(0))))).drop("_hot")
    return left.join(right, (F.col(stg_key) == F.col(lookup_key))
                     & (F.col("_salt") == F.col("_part"))).drop("_salt", "_part")
