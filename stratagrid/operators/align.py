"""Joins and alignment: exact, range and nearest keys.

Nearest joins bucket both sides by the tolerance, or look at most two neighbours up in
one sorted union; neither emits all pairs of a key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.store import written
from .ranges import default_ranges, range_of, splitters
from .segments import meet


def nearest(left: DataFrame, right: DataFrame, keys: list[str], at: str, right_at: str, take: list[str], tolerance: int | None = None, ranges: int | None = None) -> DataFrame:
    """`left` with the columns `take` of the row of `right` of equal keys whose `right_at` is nearest to `at`.

    Ties go to the later one; of equal positions the smallest `take` values. Without a
    candidate, or one within `tolerance`, they are NULL. Both sides are sorted together,
    so each left row sees just the last row before it and the first after it.

    Keys are cut, so that one with very many rows spreads over tasks: with a tolerance
    into stretches of 64 tolerances, right rows near an edge going to both sides; else
    into `ranges` of positions that share the rows evenly, and each range is handed the
    last right row before it and the first behind it, over ranges that have none.
    """
    if tolerance is None:
        cuts = splitters(left.select(F.col(at).alias("at")).unionByName(right.select(F.col(right_at).alias("at"))), "at", ranges or default_ranges(left))
        part = lambda c: range_of(c, cuts)
    else:
        part = lambda c: F.floor(c / (64 * max(1, tolerance)))
    names = [f"__k{i}" for i in range(len(keys))]
    payload = F.struct(F.col(right_at).alias("p"), *(F.col(c) for c in take))
    l = left.select(*(F.col(k).alias(n) for k, n in zip(keys, names)), F.col(at).alias("__at"), part(F.col(at)).alias("__part"), F.lit(1).alias("__side"), F.struct(*left.columns).alias("__row"), F.lit(None).alias("__pick"))
    r = right.groupBy(*keys, right_at).agg(F.min(payload).alias("__pick"))
    reach = part(F.col(right_at)) if tolerance is None else F.explode(F.sequence(part(F.col(right_at) - tolerance), part(F.col(right_at) + tolerance)))
    r = r.select(*(F.col(k).alias(n) for k, n in zip(keys, names)), F.col(right_at).alias("__at"), reach.alias("__part"), F.lit(0).alias("__side"), F.lit(None).alias("__row"), "__pick")
    both = l.unionByName(r)
    series = Window.partitionBy(*names, "__part").orderBy("__at", "__side")
    seen = both.withColumn("__before", F.last("__pick", ignorenulls=True).over(series.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    back = Window.partitionBy(*names, "__part").orderBy(F.desc("__at"), F.desc("__side"))  # a frame up to the series' end would go over the rest again for each row
    seen = seen.withColumn("__after", F.last("__pick", ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, Window.currentRow))).where("__side = 1")
    if tolerance is None:
        ends = both.groupBy(*names, "__part").agg(F.min("__pick").alias("__least"), F.max("__pick").alias("__most"))
        along = Window.partitionBy(*(names or [F.lit(0)])).orderBy("__part")  # a row for each range of a key
        ends = ends.withColumn("__from", F.last("__most", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, -1)))
        ends = ends.withColumn("__to", F.last("__least", ignorenulls=True).over(along.orderBy(F.desc("__part")).rowsBetween(Window.unboundedPreceding, -1))).drop("__least", "__most")
        seen = meet(seen, ends, names, "__part").withColumns({"__before": F.coalesce("__before", "__from"), "__after": F.coalesce("__after", "__to")})
    to = lambda c: F.abs(F.col(f"{c}.p") - F.col("__at"))
    best = F.when(F.col("__after").isNull() | (to("__before") < to("__after")), F.col("__before")).otherwise(F.col("__after"))
    seen = seen.withColumn("__best", best)
    near = F.abs(F.col("__best.p") - F.col("__at")) <= tolerance if tolerance is not None else F.lit(True)
    return seen.select("__row.*", *(F.when(near, F.col(f"__best.{c}")).alias(c if c not in left.columns else f"right_{c}") for c in take))


def nearest_level(value: Column, levels: list[float]) -> Column:
    """The nearest of a short fixed list; ties go to the larger."""
    options = F.array(*(F.struct(F.abs(value - x).alias("d"), F.lit(-x).alias("n")) for x in levels))
    return -F.array_min(options)["n"]


def nearest_cell(value: Column, first: float, step: float, n: int) -> Column:
    """Index of the nearest point of a regular axis, clipped to it; ties go to the lower index."""
    return F.greatest(F.lit(0), F.least(F.lit(n - 1), F.ceil((value - first) / step - 0.5))).cast("long")


#: Ranges that a range join sends to all tasks; more of them need a bucket width.
FEW_RANGES = 10_000


def range_join(left: DataFrame, ranges: DataFrame, at: str, start: str, end: str, how: str = "left", width: int | None = None) -> DataFrame:
    """`left` with the ranges that hold `at`: start inclusive, end exclusive, NULL ends open.

    Up to `FEW_RANGES` ranges are counted and broadcast. More of them, or with `width`
    any number (numbers only), are cut in buckets of that width (else a part of what `at`
    spans), and both sides meet by an equality join of buckets; a range is repeated for
    each bucket that it reaches into.
    """
    inside = (F.col(start).isNull() | (F.col(at) >= F.col(start))) & (F.col(end).isNull() | (F.col(at) < F.col(end)))
    if width is None:
        if ranges.limit(FEW_RANGES + 1).count() <= FEW_RANGES:
            return left.join(F.broadcast(ranges), inside, how)
        if not isinstance(left.schema[at].dataType, T.NumericType):
            raise ValueError(f"over {FEW_RANGES} ranges of {left.schema[at].dataType.simpleString()}: compare numbers")
        lo, hi = left.agg(F.min(at).cast("double"), F.max(at).cast("double")).first()
        width = max(((hi or 0.0) - (lo or 0.0)) / FEW_RANGES, 1e-9)
    bucket = lambda c: F.floor(c / width)
    span = left.agg(F.min(at).alias("__lo"), F.max(at).alias("__hi"))  # one row
    cut = ranges.join(F.broadcast(span)).withColumns({"__from": bucket(F.greatest(F.coalesce(start, "__lo"), "__lo")), "__to": bucket(F.least(F.coalesce(end, "__hi"), "__hi"))})
    cut = cut.where("__from <= __to").withColumn("__bucket", F.explode(F.sequence("__from", "__to"))).drop("__lo", "__hi", "__from", "__to")
    return left.withColumn("__at", bucket(F.col(at))).join(cut, (F.col("__at") == F.col("__bucket")) & inside, how).drop("__at", "__bucket")


def overlap(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> tuple[Column, Column]:
    """The common part of two ranges, both ends inclusive; NULLs if there is none."""
    lo, hi = F.greatest(a_start, b_start), F.least(a_end, b_end)
    return F.when(lo <= hi, lo), F.when(lo <= hi, hi)


def missing(expected: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    return expected.join(actual.select(*keys).distinct(), keys, "left_anti")


def present(wanted: DataFrame, *listings: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that each listing has."""
    for x in listings:
        wanted = wanted.join(x.select(*keys).distinct(), keys, "left_semi")
    return wanted


def labels_to_chunks(labels: DataFrame, axis: DataFrame, label: str, chunk: int) -> DataFrame:
    """`labels` with `position` on the axis (label, position), -1 if absent, `chunk` and `on_boundary`."""
    j = labels.join(axis, label, "left").withColumn("position", F.coalesce("position", F.lit(-1).cast("long")))
    known = F.col("position") >= 0
    return j.withColumns({"chunk": F.when(known, F.floor(F.col("position") / chunk)), "on_boundary": known & (F.col("position") % chunk == 0)})


def differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that only one side has, with `side`; repeated rows count."""
    one, two = a.exceptAll(b), b.select(*a.columns).exceptAll(a)
    return one.withColumn("side", F.lit("primary")).union(two.withColumn("side", F.lit("replica")))


def row_sums(df: DataFrame, by: list[Column]) -> DataFrame:
    """Per group the number of rows and two sums of their hashes, which no order changes; a null is told from its absence."""
    columns = [x for c in df.columns for x in (F.col(c), F.isnull(c))]
    total = lambda seed: F.sum(F.xxhash64(F.lit(seed), *columns).cast("decimal(20, 0)"))
    return df.groupBy(*by).agg(F.count("*").alias("n"), total(1).alias("s1"), total(2).alias("s2"))


def differences_by_digest(a: DataFrame, b: DataFrame, keys: list[str], region: Column, buckets: int = 64) -> DataFrame:
    """The rows of `differences`, found by a tree of digests: of regions, then of buckets of keys in those that differ, then rows.

    `region` is a function of `keys`. Equal regions are never shuffled, only summed up:
    what is compared row by row are the buckets of keys that differ.
    """
    b = b.select(*a.columns)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets))

    def unequal(x: DataFrame, y: DataFrame, by: dict[str, Column]) -> DataFrame:
        one, two = (row_sums(s, [c.alias(n) for n, c in by.items()]) for s in (x, y))
        one, two = one.withColumnRenamed("n", "m").toDF(*by, "m", "t1", "t2"), two
        same = reduce(lambda p, q: p & q, [one[n].eqNullSafe(two[n]) for n in by])
        j = one.join(two, same, "full")
        differ = ~(F.col("m").eqNullSafe(F.col("n")) & F.col("t1").eqNullSafe(F.col("s1")) & F.col("t2").eqNullSafe(F.col("s2")))
        return j.where(differ).select(*(F.coalesce(one[n], two[n]).alias(n) for n in by))

    def within(x: DataFrame, marked: DataFrame, by: dict[str, Column]) -> DataFrame:
        x = x.withColumns({f"__{n}": c for n, c in by.items()})
        marked = marked.select(*(F.col(n).alias(f"__{n}_") for n in by))
        return x.join(marked, reduce(lambda p, q: p & q, [F.col(f"__{n}").eqNullSafe(F.col(f"__{n}_")) for n in by]), "left_semi").select(*a.columns)

    levels = {"region": region}
    for more in ({}, {"bucket": bucket}):
        levels = levels | more
        marked = written(unequal(a, b, levels), "digests")
        a, b = within(a, marked, levels), within(b, marked, levels)
    return differences(a, b)


def longest_prefix(df: DataFrame, location: str, prefixes: DataFrame, prefix: str, take: list[str] | None = None) -> DataFrame:
    """`df` with the longest of `prefixes` that its `location` starts with, and that one's `take`; NULL if none does.

    Only prefixes of lengths that are registered can match, so a location is cut at
    those lengths (no more of them than a location has characters) and meets the
    prefixes by equality. Of equal prefixes the smallest `take` counts.
    """
    take = take or []
    known = prefixes.groupBy(F.col(prefix).alias("__prefix")).agg(F.min(F.struct(*(F.col(c) for c in take), F.lit(0).alias("__"))).alias("__take")).where("__prefix is not null")
    lengths = F.array_sort(F.collect_set(F.length("__prefix")))
    sizes = known.agg(lengths.alias("__sizes"))  # one row
    cut = df.join(F.broadcast(sizes)).withColumn("__fit", F.filter("__sizes", lambda n: n <= F.length(location)))
    places = cut.select(F.col(location).alias("__location"), "__fit").distinct()
    tried = places.select("__location", F.explode("__fit").alias("__n")).select("__location", F.expr("left(__location, __n)").alias("__prefix"))
    best = tried.join(known, "__prefix").groupBy("__location").agg(F.max_by(F.struct("__prefix", "__take"), F.length("__prefix")).alias("__best"))
    found = df.join(best, F.col(location) == F.col("__location"), "left")
    return found.select(*df.columns, F.col("__best.__prefix").alias(prefix), *(F.col(f"__best.__take.{c}").alias(c) for c in take))


def outer_pivot(df: DataFrame, row: list[str], column: str, values: list, value: Column) -> DataFrame:
    """One column per value, NULL where a row lacks it."""
    return df.groupBy(*row).agg(*(F.max(F.when(F.col(column) == v, value)).alias(str(v)) for v in values))


def first_available(df: DataFrame, keys: list[str], priority: str) -> DataFrame:
    """Of each key the row of least priority number."""
    w = Window.partitionBy(*keys).orderBy(priority)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def latest_listed(listing: DataFrame, keys: list[str], order: str, take: list[str]) -> DataFrame:
    """Of each key the last listed row; aggregates before it shuffles."""
    return listing.groupBy(*keys).agg(F.max(F.struct(order, *take)).alias("x")).select(*keys, *(f"x.{c}" for c in take))


def conflicts(groups: DataFrame, key: list[str], value: str) -> DataFrame:
    """Keys whose groups disagree on a shared value."""
    g = groups.groupBy(*key).agg(F.min(value).alias("low"), F.max(value).alias("high"))
    return g.where("low <> high")
