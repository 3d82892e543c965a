"""Exact quantiles by distributed selection: counts per range of values, then only the ranges that hold the ranks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.store import written
from .ranges import range_of, splitters
from .segments import meet

#: Rows of a key and range that are sorted together; larger ones are cut again.
SORTED = 1 << 20
#: Ranges that all values are cut in.
RANGES = 32


def quantiles(df: DataFrame, keys: list[str], value: str, shares: dict[str, float], most: int = SORTED, ranges: int = RANGES) -> DataFrame:
    """Per key exact quantiles with linear interpolation, as named columns; missing values don't count, and keys without values have NULLs.

    Values are cut in ranges by a sketch of all of them, and counted per key and range.
    The counts tell in which range each rank lies; ranges that hold none are left, and a
    range of one value is done. Those that still have over `most` rows of a key are cut
    again, on their own rows; the others are sorted, a range of a key at a time.
    """
    v = F.col(value).cast("double")
    rows = df.select(*keys, v.alias("__v"))
    whole = rows.groupBy(*keys).agg(F.count("__v").alias("__n"))
    sides = F.array(*(F.struct(F.lit(name).alias("name"), F.lit(side).alias("side"), (f(F.lit(float(s)) * (F.col("__n") - 1))).cast("long").alias("rank")) for name, s in shares.items() for side, f in ((0, F.floor), (1, F.ceil))))
    # the place of each wanted rank in the rows of its key and range
    wanted = whole.where("__n > 0").select(*keys, F.lit("").alias("__range"), F.explode(sides).alias("__w")).select(*keys, "__range", "__w.*")
    rows = rows.where(F.col("__v").isNotNull()).withColumn("__range", F.lit(""))
    found: list[DataFrame] = []
    remaining = None
    while True:
        cuts = splitters(rows, "__v", ranges)
        rows = rows.withColumn("__range", F.concat_ws(".", "__range", range_of(F.col("__v"), cuts).cast("string")) if cuts else F.col("__range"))
        outer = F.substring_index("__range", ".", -1).cast("int") if cuts else F.lit(0)
        parent = F.expr("substring(__range, 1, length(__range) - length(substring_index(__range, '.', -1)) - 1)") if cuts else F.col("__range")
        counts = rows.groupBy(*keys, "__range").agg(F.count("*").alias("n"), F.min("__v").alias("lo"), F.max("__v").alias("hi"))
        counts = counts.withColumns({"__of": parent, "__i": outer})
        before = Window.partitionBy(*keys, "__of").orderBy("__i").rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))  # at most `ranges` rows a window
        counts = counts.select(*keys, F.col("__range").alias("__inner"), F.col("__of").alias("__range"), "n", "lo", "hi", "start")
        wanted = meet(wanted, counts, keys, "__range").where("rank >= start and rank < start + n")
        wanted = wanted.select(*keys, F.col("__inner").alias("__range"), "name", "side", (F.col("rank") - F.col("start")).alias("rank"), "n", "lo", "hi")
        sizes = wanted.where("lo < hi").select(*keys, "__range", "n").distinct().agg(F.max("n").alias("largest"), F.sum("n").alias("total")).first()
        again = cuts and (sizes.largest or 0) > most and (remaining is None or sizes.total < remaining)
        if again:  # cut the lineage: what is wanted is a few rows a key
            remaining = sizes.total
            wanted = written(wanted, "quantiles")
        found.append(wanted.where("lo = hi").select(*keys, "name", "side", F.col("lo").alias("v")))
        wanted = wanted.where("lo < hi").drop("n", "lo", "hi")
        held = wanted.select(*keys, "__range").distinct()
        rows = meet(rows, held.withColumn("__held", F.lit(True)), keys, "__range").drop("__held")
        if not again:
            break
    w = Window.partitionBy(*keys, "__range").orderBy("__v")
    placed = rows.withColumn("__rank", (F.row_number().over(w) - 1).cast("long"))
    placed = meet(placed, wanted.groupBy(*keys, "__range").agg(F.collect_list(F.struct("name", "side", "rank")).alias("__want")), keys, "__range")  # two a share at most
    placed = placed.select(*keys, "__v", "__rank", F.explode("__want").alias("x")).where("__rank = x.rank")
    found.append(placed.select(*keys, "x.name", "x.side", F.col("__v").alias("v")))
    values = found[0]
    for more in found[1:]:
        values = values.unionByName(more)
    at = lambda name, side: F.max(F.when((F.col("name") == name) & (F.col("side") == side), F.col("v"))).alias(f"__{name}_{side}")
    ends = values.groupBy(*keys).agg(*(at(name, side) for name in shares for side in (0, 1))).withColumn("__one", F.lit(0))
    rows_of = whole.withColumn("__one", F.lit(0))
    j = meet(rows_of.where("__n > 0"), ends, keys, "__one")
    out = []
    for name, s in shares.items():
        place = F.lit(float(s)) * (F.col("__n") - 1)
        lo, hi = F.col(f"__{name}_0"), F.col(f"__{name}_1")
        out.append(F.when(lo == hi, lo).otherwise((F.ceil(place) - place) * lo + (place - F.floor(place)) * hi).alias(name))
    empty = whole.where("__n = 0").select(*keys, *(F.lit(None).cast("double").alias(n) for n in shares))
    return j.select(*keys, *out).unionByName(empty)
