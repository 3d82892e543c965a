"""Work planning as relations: grids, regions, filters, source files, worker shares."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def append_grid(spark: SparkSession, start: int, end: int, every: int, name: str = "time") -> DataFrame:
    """Seconds from start, end exclusive."""
    return spark.range(start, end, every).select(F.col("id").alias(name))


def product(*dims: DataFrame) -> DataFrame:
    """All combinations of dimension tables: the definition of a grid, never a join of data."""
    out = dims[0]
    for d in dims[1:]:
        out = out.crossJoin(d)
    return out


def regions(grid: DataFrame, index: str, size: int) -> DataFrame:
    """(region, start, stop): half-open index ranges that have rows."""
    g = grid.groupBy(F.floor(F.col(index) / size).alias("region")).agg(F.max(index).alias("last"))
    return g.select("region", (F.col("region") * size).alias("start"), F.least((F.col("region") + 1) * size, F.col("last") + 1).alias("stop"))


def regions_between(grid: DataFrame, index: str, label: str, size: int, start=None, end=None) -> DataFrame:
    """Whole regions that reach `start` (inclusive) and begin before `end` (exclusive)."""
    g = grid.groupBy(F.floor(F.col(index) / size).alias("region")).agg(F.min(label).alias("least"), F.max(label).alias("most"))
    if start is not None:
        g = g.where(F.col("most") >= F.lit(start))
    if end is not None:
        g = g.where(F.col("least") < F.lit(end))
    return g.select("region", "least", "most")


def regions_containing(grid: DataFrame, index: str, label: str, size: int, points: DataFrame) -> DataFrame:
    """Regions with any of the points (column `label`); unknown points count for nothing."""
    hit = grid.join(points.select(label).distinct(), label, "left_semi")
    return hit.select(F.floor(F.col(index) / size).alias("region")).distinct()


def analysis_source(valid: Column, every: int, has_hour_0: bool = True) -> tuple[Column, Column]:
    """(init, lead seconds) of a valid time: the init at or before it; one init back for variables without hour 0."""
    init = F.floor(valid / every) * every
    init = init if has_hour_0 else F.when(init == valid, init - every).otherwise(init)
    return init.cast("long"), (valid - init).cast("long")


def bit_reversal(index: Column, n: Column | int) -> Column:
    """The rank key of a spread order: the index with its bits reversed, in (n - 1).bit_length() bits."""
    n = F.lit(n) if isinstance(n, int) else n
    bits = F.greatest(F.lit(1), F.length(F.bin(F.greatest(n - 1, F.lit(0)))))
    return F.conv(F.reverse(F.lpad(F.bin(index), bits, F.lit("0"))), 2, 10).cast("long")


def assign(df: DataFrame, order: str, workers: int, how: str = "spread") -> DataFrame:
    """`df` (a plan, one row per job; `order` from 0 without holes) with `worker`: every workers-th of the spread order, or contiguous blocks."""
    n = df.agg(F.count("*").alias("__n"))
    df = df.join(F.broadcast(n))  # one row
    if how == "contiguous":
        return df.withColumn("worker", F.floor(F.col(order) / F.ceil(F.col("__n") / workers)).cast("long")).drop("__n")
    ranked = df.withColumn("__r", bit_reversal(F.col(order), F.col("__n")))
    rank = F.row_number().over(Window.orderBy("__r")) - 1  # over jobs, not data
    return ranked.withColumn("worker", (rank % workers).cast("long")).drop("__r", "__n")


def evenly_spaced(n: int, k: int) -> list[int]:
    """At most k of 0 to n - 1, evenly, ends included, halves to even."""
    if n <= 0 or k <= 0:
        return []
    return sorted({round(i * (n - 1) / (k - 1)) for i in range(k)}) if k > 1 else [0]


def newest(df: DataFrame, order: str, n: int) -> DataFrame:
    return df.orderBy(F.desc(order)).limit(n)


def expected_leads(inits: DataFrame, leads: DataFrame, init: str, lead: str, limit: Column) -> DataFrame:
    """(init, lead) pairs with lead within the init's limit; a NULL limit expects all."""
    return inits.withColumn("__limit", limit).crossJoin(leads).where(F.col("__limit").isNull() | (F.col(lead) <= F.col("__limit"))).drop("__limit")


def lead_axis(spark: SparkSession, *pieces: tuple[int, int, int]) -> DataFrame:
    """The union of ranges (start, end inclusive, step) of leads, each once."""
    out = None
    for a, b, s in pieces:
        x = spark.range(a, b + 1, s).select(F.col("id").alias("lead"))
        out = x if out is None else out.union(x)
    return out.distinct()


def probe_order(lead: Column) -> Column:
    """Sort key: the smallest lead over 0 first, 0 last."""
    return F.when(lead == 0, F.lit(1 << 62)).otherwise(lead)


#: Shards that a task lists.
PER_TASK = 1 << 25
#: Shards that follow each other along the axis that is cut in blocks.
RUN = 16


def shards_of_shape(spark: SparkSession, shape: dict[str, int], shard: dict[str, int]) -> DataFrame:
    """All shard indexes of an array: the digits of a running number, so that tasks share them evenly and nothing is joined.

    The second longest axis is cut in blocks of RUN. Blocks follow each other; in one the longest axis moves
    slowest, then the others by length, and the places in the block fastest. Every column then has long runs or
    short cycles, which columnar files keep in about half a bit a row, however long the axes are.
    """
    counts = {d: -(-n // shard[d]) for d, n in shape.items()}
    total = math.prod(counts.values())
    number = spark.range(0, total, 1, max(spark.sparkContext.defaultParallelism, -(-total // PER_TASK)))
    if not counts or not total:
        return number.select(*(F.col("id").alias(d) for d in counts))
    longest_first = sorted(counts, key=counts.get, reverse=True)
    cut = longest_first.pop(min(1, len(counts) - 1))
    stride, run = total // counts[cut], min(RUN, counts[cut])
    first, place = f"id div {stride * run} * {run}", f"id % {stride * run}"
    wide = f"least({run}, {counts[cut]} - {first})"  # the last block may be narrower
    digits = {cut: f"{first} + {place} % {wide}"}
    for d in longest_first:
        stride //= counts[d]
        digits[d] = f"{place} div {wide} div {stride} % {counts[d]}"
    return number.select(*(F.expr(digits[d]).alias(d) for d in counts))


def batches(df: DataFrame, group: list[str], order: str, most: int) -> DataFrame:
    """`df` with `batch`: runs of at most `most` rows inside each group."""
    w = Window.partitionBy(*group).orderBy(order)
    return df.withColumn("batch", F.floor((F.row_number().over(w) - 1) / most).cast("long"))


def batches_by_bytes(df: DataFrame, group: list[str], order: str, n_bytes: str, most: int) -> DataFrame:
    """`df` (plans, a row for each variable; repeated rows count once) with `batch`: runs of a group's variables of at most `most` bytes.

    A group's batches have as many variables as fit if all were as large as its largest,
    but one at least; so only a batch of a single variable may be larger than `most`.
    Missing sizes are 0.
    """
    once = df.distinct()
    w = Window.partitionBy(*group)
    largest = F.greatest(F.max(F.coalesce(F.col(n_bytes), F.lit(0))).over(w), F.lit(1))
    per = F.greatest(F.floor(F.lit(most) / largest), F.lit(1))
    return once.withColumn("batch", F.floor((F.row_number().over(w.orderBy(order)) - 1) / per).cast("long"))


def region_faults(plan: DataFrame, start: str = "start", stop: str = "stop") -> DataFrame:
    """Rows of a plan that are no half-open range of whole positions, with `fault`."""
    a, b = F.col(start), F.col(stop)
    whole = lambda c: c == F.floor(c)
    fault = F.when(a.isNull() | b.isNull(), "open").when(~(whole(a) & whole(b)), "not whole").when(a < 0, "negative").when(b <= a, "empty")
    return plan.withColumn("fault", fault).where("fault is not null")


# Fixed value: mean bytes of a message.
MESSAGE_BYTES = 55_691


def request_cost(df: DataFrame, fields: str, leads: str, members: str, message_bytes: int = MESSAGE_BYTES) -> DataFrame:
    """Messages and bytes of requests, from their numbers of fields, leads and members."""
    n = F.col(fields) * F.col(leads) * F.col(members)
    return df.withColumns({"n_messages": n, "bytes": n * message_bytes})


def reindex(df: DataFrame, axis: DataFrame, label: str, keys: DataFrame | None = None) -> DataFrame:
    """The rows of a new axis (for each of `keys`), NULL where the old one has none; other labels go."""
    frame = axis.select(label) if keys is None else product(keys, axis.select(label))
    return frame.join(df, frame.columns, "left")


def every_kth(df: DataFrame, index: str, k: int) -> DataFrame:
    return df.where(F.col(index) % k == 0)


def central_points(df: DataFrame, position: str, n: int, seed: int, draw: int = 1) -> DataFrame:
    """`draw` positions of each half of the central half of an axis of `n`, chosen by a hash of seed and position."""
    lo, mid, hi = n // 4, n // 2, n - n // 4
    inner = df.where((F.col(position) >= lo) & (F.col(position) < hi)).withColumn("half", (F.col(position) >= mid).cast("int"))
    rank = F.row_number().over(Window.partitionBy("half").orderBy(F.md5(F.concat_ws(":", F.lit(seed), F.col(position))), position))
    return inner.withColumn("__r", rank).where(F.col("__r") <= draw).drop("__r")


def quadrant(df: DataFrame, y: str, x: str, height: int, width: int, which: int) -> DataFrame:
    """One quarter of a grid: 0 to 3, by rows."""
    low, left = which // 2, which % 2
    return df.where(((F.col(y) >= height // 2).cast("int") == low) & ((F.col(x) >= width // 2).cast("int") == left))


def publication_state(counts: DataFrame, init: str, found: str) -> DataFrame:
    """Per init over its selections: published if all are found, absent if none is, else partial, which is a failure."""
    g = counts.groupBy(init).agg(F.count("*").alias("n"), F.count_if(F.col(found) > 0).alias("n_found"))
    return g.withColumn("state", F.when(F.col("n_found") == F.col("n"), "published").when(F.col("n_found") == 0, "absent").otherwise("partial"))


def archive_kind(level_type: Column, member: Column, split: int = 25) -> Column:
    """The file a message is archived in: by level type and member 0, up to `split`, or above."""
    part = F.when(member == 0, "control").when(member <= split, "low").otherwise("high")
    return F.concat_ws("-", level_type, part)


def box(df: DataFrame, reference: DataFrame, lat: str, lon: str) -> DataFrame:
    """Rows within the latitudes and longitudes that `reference` spans."""
    span = reference.agg(F.min(lat).alias("__a"), F.max(lat).alias("__b"), F.min(lon).alias("__c"), F.max(lon).alias("__d"))
    j = df.join(F.broadcast(span))  # one row
    return j.where(F.col(lat).between(F.col("__a"), F.col("__b")) & F.col(lon).between(F.col("__c"), F.col("__d"))).drop("__a", "__b", "__c", "__d")


def recent_inits(spark: SparkSession, now: int, delay: int, n: int, earliest: int, every: int = 86400) -> DataFrame:
    """(init, rank): the last n inits that are `delay` seconds old, newest first, none before `earliest`."""
    last = (now - delay) // every * every
    return spark.range(n).select((F.lit(last) - F.col("id") * every).alias("init"), (F.col("id") + 1).alias("rank")).where(F.col("init") >= earliest)
