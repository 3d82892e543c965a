"""Series cut in regions: what one region hands on to the next.

A scan along a series that is cut in regions has two levels. Each region first says what
it hands on (its first row and its last live one), a row a region. These are carried
forward along each series, over regions that hand on nothing, so a missing or skipped
step at a border changes nothing. Each region then finishes with what was carried to it,
and regions of one series are worked on by different tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _whole(keys: list[str]) -> list:
    return keys or [F.lit(0)]


def meet(rows: DataFrame, ends: DataFrame, keys: list[str], region: str) -> DataFrame:
    """`rows` with the other columns of `ends`, by region and keys; null keys are equal."""
    renamed = ends.select(*(F.col(k).alias(f"__meet{i}") for i, k in enumerate(keys)), F.col(region).alias("__of"), *(c for c in ends.columns if c not in (*keys, region)))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__meet{i}")) for i, k in enumerate(keys)], F.col(region).eqNullSafe(F.col("__of")))
    return rows.join(renamed, same).drop("__of", *(f"__meet{i}" for i in range(len(keys))))


def previous_live(df: DataFrame, keys: list[str], order: str, take: dict[str, Column], region: Column, skip: Column | None = None) -> DataFrame:
    """`df` with __live and __prev, a struct of `order` and `take` of the last live row before it in its series; NULL at the first row.

    Rows marked by `skip` aren't live, except a series' first row. Regions ascend with
    `order`. Of rows of one place the one of the largest `take` is the last.
    """
    skipped = F.coalesce(skip, F.lit(False)) if skip is not None else F.lit(False)
    row = F.struct(F.col(order).alias("at"), *(c.alias(n) for n, c in take.items()))
    rows = df.withColumns({"__region": region, "__skipped": skipped, "__self": row})
    ends = rows.groupBy(*keys, "__region").agg(F.min("__self").alias("__first"), F.max(F.when(~F.col("__skipped"), F.col("__self"))).alias("__last"))
    along = Window.partitionBy(*_whole(keys)).orderBy("__region")  # a row for each region of a series
    opens = F.row_number().over(along) == 1
    ends = ends.withColumn("__opens", opens).withColumn("__handed", F.coalesce("__last", F.when(F.col("__opens"), F.col("__first"))))
    ends = ends.withColumn("__carried", F.last("__handed", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, -1)))
    rows = meet(rows, ends.select(*keys, "__region", "__opens", "__carried"), keys, "__region")
    inside = Window.partitionBy(*keys, "__region").orderBy(order, "__self")
    rows = rows.withColumn("__live", ~F.col("__skipped") | (F.col("__opens") & (F.row_number().over(inside) == 1)))
    before = F.last(F.when(F.col("__live"), F.col("__self")), ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("__prev", F.coalesce(before, "__carried")).drop("__region", "__skipped", "__self", "__opens", "__carried")


def running_sum(df: DataFrame, keys: list[str], order: str, value: str, region: Column, out: str) -> DataFrame:
    """`df` with the sum of `value` over its series up to and with each row, by two levels: inside regions, and of the regions before.

    Regions ascend with `order`. Rows of one place are summed together; missing values are 0.
    """
    rows = df.withColumns({"__region": region, "__v": F.coalesce(F.col(value), F.lit(0))})
    sums = rows.groupBy(*keys, "__region").agg(F.sum("__v").alias("__sum"))
    along = Window.partitionBy(*_whole(keys)).orderBy("__region").rowsBetween(Window.unboundedPreceding, -1)  # a row for each region of a series
    sums = sums.select(*keys, "__region", F.coalesce(F.sum("__sum").over(along), F.lit(0)).alias("__before"))
    inside = Window.partitionBy(*keys, "__region").orderBy(order)
    rows = rows.withColumn("__inside", F.sum("__v").over(inside))
    return meet(rows, sums, keys, "__region").withColumn(out, F.col("__before") + F.col("__inside")).drop("__region", "__v", "__inside", "__before")


def following(df: DataFrame, keys: list[str], order: str, region: Column, out: str) -> DataFrame:
    """`df` with the next larger `order` of its series; NULL at the last. Regions, which ascend with `order`, are handed the first place behind them."""
    rows = df.withColumn("__region", region)
    ends = rows.groupBy(*keys, "__region").agg(F.min(order).alias("__first"))
    # downwards, as Spark goes over the rest of a frame again for each row if it reaches to the series' end
    along = Window.partitionBy(*_whole(keys)).orderBy(F.desc("__region")).rowsBetween(Window.unboundedPreceding, -1)  # a row for each region of a series
    ends = ends.select(*keys, "__region", F.last("__first", ignorenulls=True).over(along).alias("__behind"))
    inside = Window.partitionBy(*keys, "__region").orderBy(F.desc(order)).rangeBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("__next", F.min(order).over(inside))
    return meet(rows, ends, keys, "__region").withColumn(out, F.coalesce("__next", "__behind")).drop("__region", "__next", "__behind")


def _halo(rows: DataFrame, keys: list[str], order: str, live: Column, n: int, later: bool) -> DataFrame:
    """(keys, region, __halo): the n live rows next before each region, or with `later` behind it, however far they are."""
    toward = (F.asc if later else F.desc)
    row = F.struct(F.col(order).alias("at"), F.struct(*rows.columns).alias("row"))
    nearest = Window.partitionBy(*keys, "region").orderBy(toward(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = rows.select("*", row.alias("__row"), live.alias("__live")).withColumn("__rank", F.sum(F.col("__live").cast("int")).over(nearest))
    first_n = lambda rows_of: F.slice(F.sort_array(rows_of, asc=later), 1, n)
    ends = own.groupBy(*keys, "region").agg(F.collect_list(F.when(F.col("__live") & (F.col("__rank") <= n), F.col("__row"))).alias("__own"), F.min("__row").alias("__first"))  # n rows at most
    along = Window.partitionBy(*_whole(keys)).orderBy((F.desc if later else F.asc)("region"))
    if not later:  # a series' first row is live
        ends = ends.withColumn("__own", F.when(F.row_number().over(along) == 1, F.array_union("__own", F.array("__first"))).otherwise(F.col("__own")))
    gives = F.size("__own") > 0
    givers = Window.partitionBy(*keys, gives).orderBy((F.desc if later else F.asc)("region")).rowsBetween(1 - n, 0)
    ends = ends.withColumn("__through", F.when(gives, first_n(F.flatten(F.collect_list("__own").over(givers)))))  # of the last n regions that give any
    carried = F.last("__through", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, -1))
    return ends.select(*keys, "region", carried.alias("__halo"))


def with_halo(df: DataFrame, keys: list[str], order: str, size: int, before: int = 1, after: int = 0, skip: str | None = None) -> DataFrame:
    """The rows of each series with their `region` (order div size), and again in another region as its halo; `own` marks a region's own.

    A region's halo are the `before` last rows of its series before it and the `after`
    first ones behind it, wherever they are; rows marked by `skip` are in no halo, except
    a series' first row. Regions without rows have none.
    """
    rows = df.withColumn("region", F.floor(F.col(order) / size))
    live = ~F.coalesce(F.col(skip), F.lit(False)) if skip else F.lit(True)
    out = rows.withColumn("own", F.lit(True))
    for n, later in ((before, False), (after, True)):
        if n:
            halo = _halo(rows, keys, order, live, n, later).select("region", F.explode("__halo.row").alias("__row"))
            out = out.unionByName(halo.select(*(F.col("__row")[c].alias(c) for c in df.columns), "region", F.lit(False).alias("own")))
    return out


def trim_halo(df: DataFrame) -> DataFrame:
    return df.where("own").drop("own")
