"""Ranges of a column that share the rows evenly, from a bounded sketch of its values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Ranges at most; a sketch of the values that tells them apart to a 4000th of the rows.
MOST, ACCURACY = 256, 4000


def splitters(df: DataFrame, at: str, ranges: int) -> list:
    """Values that cut the non-null values of `at` in about `ranges` equal parts; at most `MOST` - 1 numbers reach the driver."""
    n = max(1, min(MOST, ranges))
    if n == 1:
        return []
    found = df.agg(F.percentile_approx(at, [i / n for i in range(1, n)], ACCURACY)).first()[0]
    return sorted(set(found or []))


def range_of(at: Column, cuts: list) -> Column:
    """How many of the ascending `cuts` are at or below `at`, by a tree of comparisons; 0 for NULL."""
    if not cuts:
        return F.lit(0)
    half = len(cuts) // 2

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(at < F.lit(cuts[mid]), tree(lo, mid)).otherwise(tree(mid + 1, hi))

    return F.when(at.isNull(), F.lit(0)).when(at < F.lit(cuts[half]), tree(0, half)).otherwise(tree(half + 1, len(cuts)))


def default_ranges(df: DataFrame) -> int:
    """As many ranges as a shuffle has partitions."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
