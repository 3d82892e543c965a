"""Aggregations over cells, positions and files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .quantile import quantiles as quantiles


def null_fraction(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Per key the share of missing cells, with counts."""
    bad = F.col(value).isNull() | F.isnan(F.col(value).cast("double"))
    return df.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if(bad).alias("n_missing")).withColumn("fraction", F.col("n_missing") / F.col("n"))


def availability(df: DataFrame, keys: list[str], first: str, second: str) -> DataFrame:
    """1 less the mean of the missing shares at two points."""
    n1, n2 = F.avg(F.col(first).isNull().cast("int")), F.avg(F.col(second).isNull().cast("int"))
    return df.groupBy(*keys).agg((1 - (n1 + n2) / 2).alias("availability"))


def completeness(expected: DataFrame, present: DataFrame, position: list[str], item: list[str]) -> DataFrame:
    """Per position: items expected, missing and the share present. Extra items don't count."""
    have = present.select(*position, *item).distinct().withColumn("__have", F.lit(1))
    j = expected.join(have, position + item, "left")
    g = j.groupBy(*position).agg(F.count("*").alias("n_expected"), F.count_if(F.col("__have").isNull()).alias("n_missing"))
    return g.withColumn("ratio", (F.col("n_expected") - F.col("n_missing")) / F.col("n_expected"))


def completeness_of_product(items: DataFrame, positions: DataFrame, present: DataFrame, position: str, item: str) -> DataFrame:
    """`completeness` where every item is expected at every position, without making the pairs.

    item: a column of numbers. Present items are bits: a bitmap for each position and
    32,768 numbers, made before the shuffle and united behind it; their bits are counted
    and taken from the number of expected items.
    """
    expected = items.select(item).where(F.col(item).isNotNull()).distinct()
    held = present.select(position, item).join(expected, item, "left_semi")
    maps = held.groupBy(position, F.bitmap_bucket_number(item).alias("__bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(item)).alias("__bits"))
    have = maps.groupBy(F.col(position).alias("__position")).agg(F.sum(F.bitmap_count("__bits")).alias("__n"))
    total = expected.agg(F.count("*").alias("n_expected"))
    j = positions.select(position).distinct().join(have, F.col(position).eqNullSafe(F.col("__position")), "left").join(F.broadcast(total))  # one row
    j = j.select(position, "n_expected", (F.col("n_expected") - F.coalesce("__n", F.lit(0))).alias("n_missing")).where("n_expected > 0")
    return j.withColumn("ratio", (F.col("n_expected") - F.col("n_missing")) / F.col("n_expected"))


def completeness_summary(by_position: DataFrame, position: str) -> DataFrame:
    whole = F.col("n_missing") == 0
    return by_position.agg(F.count("*").alias("n_positions"), F.count_if(whole).alias("n_complete"), F.min(F.when(~whole, F.col(position))).alias("first_incomplete"), F.max(F.when(~whole, F.col(position))).alias("last_incomplete"))


def fold_files(df: DataFrame, keys: list[str], file: str, present: str) -> DataFrame:
    """Files counted once per key, present if any of their rows is."""
    once = df.groupBy(*keys, file).agg(F.max(F.col(present).cast("int")).alias("p"))
    return once.groupBy(*keys).agg(F.sum("p").cast("long").alias("n_present"), F.count("*").alias("n_expected"))


def mean_std(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Mean and population deviation per key, missing cells skipped."""
    return df.groupBy(*keys).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), F.count(value).alias("n"))


def series_summary(series: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The mean, least and largest of a series' means, and its mean deviation (of each of `keys`)."""
    return series.groupBy(*(keys or [])).agg(F.avg("mean").alias("mean"), F.min("mean").alias("least"), F.max("mean").alias("most"), F.avg("std").alias("std"))


def spatial_stats(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(value).alias("least"), F.max(value).alias("most"), F.avg(value).alias("mean"))


def histogram(df: DataFrame, value: str, bins: int = 40) -> DataFrame:
    """(bin, n, density) of equal bins over the range; the largest value is in the last bin."""
    span = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"), F.count(value).alias("total"))
    j = df.where(F.col(value).isNotNull()).join(F.broadcast(span))  # one row
    width = (F.col("hi") - F.col("lo")) / bins
    b = F.least(F.lit(bins - 1), F.coalesce(F.floor(F.try_divide(F.col(value) - F.col("lo"), width)), F.lit(0))).cast("long")
    g = j.groupBy(b.alias("bin")).agg(F.count("*").alias("n"), F.first("total").alias("total"), F.first(width).alias("width"))
    return g.select("bin", "n", F.try_divide(F.col("n").cast("double"), F.col("total") * F.col("width")).alias("density"))


def block_mean(df: DataFrame, index: str, value: str, n: int, blocks: int, keys: list[str] | None = None) -> DataFrame:
    """Means of at most `blocks` runs of an axis of `n` steps, missing cells skipped."""
    size = min(blocks, n)
    return df.groupBy(*(keys or []), F.floor(F.col(index) * size / n).alias("block")).agg(F.avg(value).alias("mean"))


def last_success(df: DataFrame, keys: list[str], position: str, status: str = "status") -> DataFrame:
    return df.groupBy(*keys).agg(F.max(F.when(F.col(status) == "Succeeded", F.col(position))).alias("last_success"))


def inventory(expected: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, fault): missing, unexpected or duplicate."""
    counts = actual.groupBy(*keys).agg(F.count("*").alias("n"))
    j = expected.select(*keys).distinct().withColumn("__e", F.lit(1)).join(counts, keys, "full")
    fault = F.when(F.col("n").isNull(), "missing").when(F.col("__e").isNull(), "unexpected").when(F.col("n") > 1, "duplicate")
    return j.select(*keys, fault.alias("fault")).where("fault is not null")


def worst(df: DataFrame, keys: list[str], fraction: str, error: str) -> DataFrame:
    """Per key the least missing share over samples, and the first error by sample order."""
    return df.groupBy(*keys).agg(F.min(fraction).alias("least_fraction"), F.min(error).alias("first_error"))


def distinct_sizes(df: DataFrame, keys: list[str], size: str) -> DataFrame:
    """Groups whose members differ in size."""
    return df.groupBy(*keys).agg(F.min(size).alias("least"), F.max(size).alias("most")).where("least <> most")


def sibling_mean(df: DataFrame, group: list[str], member: str, value: str) -> DataFrame:
    """Each member's mean of the other members' values in its group."""
    w = Window.partitionBy(*group)
    rest: Column = F.try_divide(F.sum(value).over(w) - F.coalesce(F.col(value), F.lit(0)), F.count(value).over(w) - F.when(F.col(value).isNull(), 0).otherwise(1))
    return df.select(*group, member, rest.alias("siblings"))


def comparison(a: DataFrame, b: DataFrame, on: list[str], keys: list[str], value: str) -> DataFrame:
    """Per key over cells of both: how many there are, both means, the bias and the largest difference."""
    j = a.select(*on, *(k for k in keys if k not in on), F.col(value).alias("__a")).join(b.select(*on, F.col(value).alias("__b")), on)
    d = F.col("__a") - F.col("__b")
    return j.groupBy(*keys).agg(F.count(d).alias("n"), F.avg("__a").alias("mean"), F.avg("__b").alias("reference_mean"), F.avg(d).alias("bias"), F.max(F.abs(d)).alias("largest"))


def probe(expected: DataFrame, present: DataFrame, position: list[str], file: str) -> DataFrame:
    """Per position: files present, and the names of those missing."""
    have = present.select(*position, file).distinct().withColumn("__have", F.lit(1))
    j = expected.join(have, [*position, file], "left")
    names = F.array_sort(F.collect_list(F.when(F.col("__have").isNull(), F.col(file))))
    return j.groupBy(*position).agg(F.count("__have").alias("n_present"), names.alias("missing"))
