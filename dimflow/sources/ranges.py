"""Ranges of a numeric key that hold about equal counts.

JDBC reads split a table by ranges of a key.  Equal widths leave most rows in a
few ranges when keys are uneven; bounds from a quantile sketch do not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def equal_count_bounds(df: DataFrame, key: str, ranges: int, accuracy: int = 10_000) -> list:
    """The inner bounds of ``ranges`` ranges, ascending and distinct: quantiles
    by a sketch that partitions merge (rank error rows / ``accuracy``)."""
    at = [i / ranges for i in range(1, ranges)]
    found = df.agg(F.percentile_approx(key, at, accuracy).alias("b")).first().b
    return sorted(set(found or []))


def range_predicates(key: str, bounds: list) -> list[str]:
    """One condition a range for ``spark.read.jdbc(predicates=...)``; together
    they take every row once (the first also takes null keys)."""
    if not bounds:
        return [f"{key} IS NULL OR {key} IS NOT NULL"]
    out = [f"{key} < {bounds[0]} OR {key} IS NULL"]
    out += [f"{key} >= {lo} AND {key} < {hi}" for lo, hi in zip(bounds, bounds[1:])]
    return out + [f"{key} >= {bounds[-1]}"]
