"""Dataset declarations, and the ingest query they stand for."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalar
from ..operators import series


@dataclass(frozen=True)
class Variable:
    """How a variable's values are treated, in this order: mask, scale, rate, fill, scale after, round."""

    name: str
    sentinel: float | None = None
    factor: float = 1.0
    offset: float = 0.0
    rate: str | None = None  # accumulated, running_mean or signed
    reset: int | None = None
    clamp: float | None = series.CLAMP_PRECIPITATION
    fill_gaps: bool = False
    factor_after: float = 1.0
    keep_bits: int | None = None
    categorical: bool = False
    since: int | None = None


@dataclass(frozen=True)
class Dataset:
    name: str
    keys: tuple[str, ...]
    append: str
    first: int
    every: int
    region: int
    variables: tuple[Variable, ...] = field(default=())

    def schema(self) -> T.StructType:
        keys = [T.StructField(k, T.LongType(), False) for k in (*self.keys, self.append)]
        return T.StructType([*keys, T.StructField("var", T.StringType(), False), T.StructField("value", T.FloatType())])

    def available(self, position: int) -> list[Variable]:
        """Variables that exist at a position of the append dimension."""
        return [v for v in self.variables if v.since is None or v.since <= position]


def overwrite_guard(published: Dataset, new: Dataset, allow_new_variables: bool = False, allow_growth: bool = False, published_end: int | None = None, new_end: int | None = None) -> list[str]:
    """Why `new` may not replace `published`; nothing if it may.

    The ends are the last positions along the append dimension: a smaller new one is
    never allowed, a larger one only with `allow_growth`.
    """
    faults = [f"{x} changed" for x in ("keys", "append", "first", "every", "region") if getattr(published, x) != getattr(new, x)]
    old, now = {v.name: v for v in published.variables}, {v.name: v for v in new.variables}
    faults += [f"{n} is gone" for n in old if n not in now] + [f"{n} changed" for n in old if n in now and old[n] != now[n]]
    if not allow_new_variables:
        faults += [f"{n} is new" for n in now if n not in old]
    if published_end is not None and new_end is not None:
        if new_end < published_end:
            faults.append(f"{published.append} would end at {new_end} instead of {published_end}")
        elif new_end > published_end and not allow_growth:
            faults.append(f"{published.append} would grow to {new_end} from {published_end}")
    return faults


def with_coordinates(df: DataFrame, derived: dict[str, Callable[[DataFrame], Column]]) -> DataFrame:
    """`df` with coordinates that a dataset derives from its others, in their order."""
    for name, make in derived.items():
        df = df.withColumn(name, make(df))
    return df


def _treatment(v: Variable) -> tuple:
    """What decides the plan of a variable; the other attributes are numbers that go in as columns."""
    return v.rate, v.reset, v.clamp, v.fill_gaps and not v.categorical, v.keep_bits


def _by_variable(variables: list[Variable], attribute: str, otherwise: float | None) -> Column:
    """The attribute of a row's variable; a literal if it is the same for all."""
    values = {v.name: getattr(v, attribute) for v in variables}
    if len(set(values.values())) == 1:
        return F.lit(next(iter(values.values()))).cast("double")
    named = {k: float(v) for k, v in values.items() if v is not None and v != otherwise}
    return F.coalesce(F.create_map(*(F.lit(x) for kv in named.items() for x in kv))[F.col("var")], F.lit(otherwise).cast("double"))


def _transform(cells: DataFrame, variables: list[Variable], keys: list[str], seconds: str, value: str, gap: str | None, region: Column | None = None) -> DataFrame:
    """Cells of variables of one treatment."""
    rate, reset, clamp, fill, bits = _treatment(variables[0])
    x = F.col(value)
    if any(v.sentinel is not None for v in variables):
        x = F.when(~F.coalesce(x.cast("float") == _by_variable(variables, "sentinel", None).cast("float"), F.lit(False)), x)
    x = series.nulls(x.cast("double"))
    if any(v.factor != 1.0 or v.offset for v in variables):
        x = x * _by_variable(variables, "factor", 1.0) + _by_variable(variables, "offset", 0.0)
    df = cells.withColumn(value, x)
    if rate:
        df = series.deaccumulate(df, keys, seconds, value, reset=reset, mode=rate, clamp=clamp, out="__rate", region=region).withColumn(value, F.col("__rate")).drop("__rate", "clamped", "invalid")
    if fill and gap:
        df = series.interpolate_flagged(df, keys, seconds, value, gap, out="__filled").withColumn(value, F.col("__filled")).drop("__filled")
    x = F.col(value)
    if any(v.factor_after != 1.0 for v in variables):
        x = x * _by_variable(variables, "factor_after", 1.0)
    return df.withColumn(value, scalar.round_mantissa(x, bits) if bits is not None else x.cast("float"))


def transform(cells: DataFrame, v: Variable, keys: list[str], seconds: str, value: str = "value", gap: str | None = None) -> DataFrame:
    """The cells (keys, seconds, value) of one variable with `value` as it is published."""
    return _transform(cells, [v], keys, seconds, value, gap)


def transform_all(cells: DataFrame, dataset: Dataset, seconds: str, gap: str | None = None, region: Column | None = None) -> DataFrame:
    """Long cells (keys, seconds, var, value) of all variables.

    Variables of equal treatment (rate, reset, clamp, filling, rounding) are one branch
    of the plan and one scan, whatever their sentinels, factors and offsets are. Series
    are cut at `region`, if it is given, for rates.
    """
    groups: dict[tuple, list[Variable]] = {}
    for v in dataset.variables:
        groups.setdefault(_treatment(v), []).append(v)
    parts = [_transform(cells.where(F.col("var").isin([v.name for v in g])), g, [*dataset.keys, "var"], seconds, "value", gap, region) for g in groups.values()]
    return reduce(DataFrame.unionByName, parts)
