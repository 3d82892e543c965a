"""Places in a total order, without a window over all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Workspace

#: Bits of `at` that count rows of one partition; the bits above number the partitions.
PLACE_BITS = 33


def in_order(df: DataFrame, order: list[Column], space: Workspace) -> DataFrame:
    """`df`, written in the order of `order` by ranges, with `at`: ascending, consecutive inside a partition.

    Ranges are drawn from a sample, so a heavy first column is cut by the later ones.
    """
    laid = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return space.cut(laid.withColumn("at", F.monotonically_increasing_id()))


def part(at: str = "at") -> Column:
    """The range partition of a row."""
    return F.shiftright(F.col(at), PLACE_BITS)


def with_rank(df: DataFrame, order: list[Column], space: Workspace, name: str) -> DataFrame:
    """`df` with its rank (1, 2, ...) in the order of `order`: counts of the ranges are added up, a row a range."""
    laid = in_order(df, order, space).withColumn("__part", part())
    counts = laid.groupBy("__part").agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("__part", before.alias("__before"))  # a row for each range, at most as many as shuffle partitions
    place = F.col("at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return laid.join(F.broadcast(offsets), "__part").withColumn(name, F.col("__before") + place + 1).drop("__part", "__before", "at")
