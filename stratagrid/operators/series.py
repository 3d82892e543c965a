"""Operators along the time axis of series: rates from accumulations, gaps, recency.

A series is the rows of equal `keys`, in order of a long column of seconds (or steps).
Missing values are NULL; `nulls` turns NaN into NULL on the way in. Series are the unit
of parallel work; long ones are cut in regions, which carry over what the next one needs
(`segments`), so that a series of any length spreads over many tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .segments import previous_live

# Rates below 0 down to these are noise and become 0; below them they become missing.
CLAMP_PRECIPITATION, CLAMP_FLUX, CLAMP_RADIATION = -7e-5, -50.0, -1000.0


def nulls(value: Column | str) -> Column:
    """NaN as NULL."""
    c = F.col(value) if isinstance(value, str) else value
    return F.when(~F.isnan(c), c)


def deaccumulate(df: DataFrame, keys: list[str], seconds: str, value: str, reset: int | None = None, skip: str | None = None, mode: str = "accumulated", clamp: float | None = CLAMP_PRECIPITATION, out: str = "rate", region: Column | None = None) -> DataFrame:
    """`df` with `out`, `clamped` and `invalid`.

    accumulated: (A - A_prev) / dt; running_mean: A + (A - A_prev) * t_prev / dt, with
    t_prev the seconds since the last reset; signed: plain difference over dt, without
    reset or clamp. After a row on a multiple of `reset` seconds the baseline is 0.
    Rows marked by `skip` keep their value and are nobody's predecessor, but the first
    row always is. The first row has no rate. Ties in `seconds` have none either. With
    `region`, which ascends with `seconds`, a series is cut there and each region works
    with what was carried to it; the result is the same.
    """
    t, a = F.col(seconds), F.col(value).cast("double")
    if region is not None:
        df = previous_live(df, keys, seconds, {"value": a}, region, F.col(skip) if skip else None)
        df = df.withColumns({"__t": F.col("__prev.at"), "__a": F.col("__prev.value")}).drop("__prev")
    else:
        series = Window.partitionBy(*keys).orderBy(seconds)
        first = F.row_number().over(series) == 1
        live = first | ~F.coalesce(F.col(skip), F.lit(False)) if skip else F.lit(True)
        df = df.withColumn("__live", live)
        before = (Window.partitionBy(*keys, "__live") if skip else Window.partitionBy(*keys)).orderBy(seconds)
        df = df.withColumn("__t", F.lag(seconds).over(before)).withColumn("__a", F.lag(a).over(before))
    step = (t - F.col("__t")).cast("double")
    at_reset = F.col("__t") % reset == 0 if reset and mode != "signed" else F.lit(False)
    base = F.when(at_reset, 0.0).otherwise(F.col("__a"))
    if mode == "running_mean":
        raw = a + F.try_divide((a - base) * (F.col("__t") % reset if reset else F.col("__t")).cast("double"), step)
    elif mode in ("accumulated", "signed"):
        raw = F.try_divide(a - base, step)
    else:
        raise ValueError(f"unknown mode {mode}")
    raw = F.when(F.col("__t").isNull(), None).otherwise(raw)
    df = df.withColumn("__raw", raw)
    if mode == "signed" or clamp is None:
        clamped = invalid = F.lit(False)
        rate = F.col("__raw")
    else:
        clamped = F.coalesce((F.col("__raw") < 0) & (F.col("__raw") > clamp), F.lit(False))
        invalid = F.coalesce(F.col("__raw") <= clamp, F.lit(False))
        rate = F.when(clamped, 0.0).when(invalid, None).otherwise(F.col("__raw"))
    kept = F.when(~F.col("__live"), a).otherwise(rate)
    off = ~F.col("__live")
    df = df.withColumns({out: kept, "clamped": clamped & ~off, "invalid": invalid & ~off})
    return df.drop("__live", "__t", "__a", "__raw")


def deaccumulation_faults(df: DataFrame, keys: list[str], most_invalid: float = 0.0, most_clamped: float = 0.05) -> DataFrame:
    """Per group of `keys`: counts and shares of clamped and invalid rows, and whether a limit is passed."""
    n = F.count("*")
    g = df.groupBy(*keys).agg(n.alias("n"), F.count_if("clamped").alias("n_clamped"), F.count_if("invalid").alias("n_invalid"))
    return g.withColumn("failed", (F.col("n_invalid") / F.col("n") > most_invalid) | (F.col("n_clamped") / F.col("n") > most_clamped))


def interpolate_flagged(df: DataFrame, keys: list[str], order: str, value: str, flag: str, out: str = "filled") -> DataFrame:
    """At flagged rows the midpoint of both neighbours; at the ends, and where a neighbour is missing, see below.

    Flagged first and last rows keep their value; a missing neighbour makes the result missing.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    inner = F.lag(F.lit(1)).over(w).isNotNull() & F.lead(F.lit(1)).over(w).isNotNull()
    middle = (F.lag(value).over(w) + F.lead(value).over(w)) / 2
    return df.withColumn(out, F.when(F.coalesce(F.col(flag), F.lit(False)) & inner, middle).otherwise(F.col(value)))


def drop_last_step(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Without each series' last step, into which accumulations reach."""
    w = Window.partitionBy(*keys)
    return df.withColumn("__last", F.max(order).over(w)).where(F.col(order) < F.col("__last")).drop("__last")


def recency_tier(df: DataFrame, order: str, tiers: list[float], keys: list[str] | None = None, out: str = "limit") -> DataFrame:
    """`df` with its rank from the newest (`rank`, from 1) and the tier of that rank; the last tier extends."""
    w = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(F.desc(order))
    ranked = df.withColumn("rank", F.row_number().over(w).cast("long"))
    limits = F.array(*(F.lit(float(t)) for t in tiers))
    return ranked.withColumn(out, F.element_at(limits, F.least("rank", F.lit(len(tiers))).cast("int")))


def due_position(now: Column, first: Column, every: int, delay: int) -> Column:
    """The newest position of the grid first, first + every, ... that is `delay` seconds old; NULL before the first."""
    n = F.floor((now - delay - first) / every)
    return F.when(n >= 0, first + n * every)


def contiguous(df: DataFrame, order: str, step: int, keys: list[str] | None = None, stretch: int = 4096) -> DataFrame:
    """Rows whose distance from the row before them in their series isn't `step`, with it as `gap`.

    A series is cut in stretches of `stretch` steps, so that a long one is spread over
    many tasks; each stretch's first row is compared with the last one of the stretches
    before it.
    """
    keys = keys or []
    cut = df.withColumn("__stretch", F.floor(F.col(order) / (step * stretch)))
    ends = cut.groupBy(*keys, "__stretch").agg(F.max(order).alias("__end"))  # a row a stretch
    before = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("__stretch")
    ends = ends.select(*(F.col(k).alias(f"__{k}") for k in keys), F.col("__stretch").alias("__of"), F.lag("__end").over(before).alias("__before"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys], F.col("__stretch") == F.col("__of"))
    w = Window.partitionBy(*keys, "__stretch").orderBy(order)
    rows = cut.withColumn("__last", F.lag(order).over(w)).join(ends, same)
    gap = F.col(order) - F.coalesce("__last", "__before", F.col(order) - step)
    return rows.select(*(F.col(c) for c in df.columns), gap.alias("gap")).where(F.col("gap") != step)
