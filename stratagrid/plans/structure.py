"""The structure of a published table as relations, and what may replace it.

`arrays` has a row for each variable: path, dims, dtype, chunks, shards (arrays of
names and sizes are text, so that any field compares as text). `coords` has a row for
each value of a coordinate: coord, index, value. `sizes` has the length of the append
dimension of each group: group, size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FAULTS = ("path", "fault", "published", "new")


def signature(arrays: DataFrame, path: str = "path") -> DataFrame:
    """(path, field, value): a row for each structural field of each array."""
    fields = [c for c in arrays.columns if c != path]
    pairs = F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in fields))
    return arrays.select(F.col(path).alias("path"), F.explode(pairs).alias("x")).select("path", "x.field", "x.value")


def _faults(df: DataFrame, path: str, fault: str, published: str = "NULL", new: str = "NULL") -> DataFrame:
    return df.selectExpr(f"cast({path} as string) as path", f"'{fault}' as fault", f"cast({published} as string) as published", f"cast({new} as string) as new")


def array_drift(published: DataFrame, new: DataFrame) -> DataFrame:
    """Published arrays that are missing from `new`, and fields that differ; new arrays are allowed."""
    gone = published.join(new, "path", "left_anti")
    a, b = signature(published).withColumnRenamed("value", "published"), signature(new).withColumnRenamed("value", "new")
    changed = a.join(b, ["path", "field"]).where(~F.col("published").eqNullSafe(F.col("new")))
    changed = changed.select("path", F.concat(F.col("field"), F.lit(" differs")).alias("fault"), "published", "new")
    return _faults(gone, "path", "missing").union(changed)


def coordinate_drift(published: DataFrame, new: DataFrame) -> DataFrame:
    """Published coordinates (of other dimensions than the append one) that are missing from `new` or whose values differ."""
    names = new.select("coord").distinct()
    gone = published.join(names, "coord", "left_anti").select("coord").distinct()
    both = published.select("coord").distinct().join(names, "coord")
    a, b = (df.join(both, "coord").select("coord", "index", F.col("value").cast("string").alias(as_), F.lit(True).alias(f"in_{as_}")) for df, as_ in ((published, "published"), (new, "new")))
    differ = a.join(b, ["coord", "index"], "full").where("in_published is null or in_new is null or not (published <=> new)")
    return _faults(gone, "coord", "missing").union(_faults(differ.select("coord").distinct(), "coord", "values differ"))


def extent_faults(published: DataFrame, new: DataFrame, allow_growth: bool) -> DataFrame:
    """Groups of both that would be shorter along the append dimension, or longer without leave."""
    both = published.withColumnRenamed("size", "published").join(new.withColumnRenamed("size", "new"), "group")
    short = _faults(both.where("new < published"), "group", "trimming is never allowed", "published", "new")
    return short if allow_growth else short.union(_faults(both.where("new > published"), "group", "growth is not allowed", "published", "new"))


def overwrite_faults(published: dict[str, DataFrame], new: dict[str, DataFrame], allow_new_arrays: bool = False, allow_growth: bool = False) -> DataFrame:
    """(path, fault, published, new): why `new` may not be written over `published`; both are dicts of arrays, coords and sizes."""
    parts = [array_drift(published["arrays"], new["arrays"]), coordinate_drift(published["coords"], new["coords"]), extent_faults(published["sizes"], new["sizes"], allow_growth)]
    if not allow_new_arrays:
        parts.append(_faults(new["arrays"].join(published["arrays"], "path", "left_anti"), "path", "new array"))
    return reduce(DataFrame.union, parts)


def retractions(published: DataFrame, new: DataFrame) -> DataFrame:
    """Groups whose published extent an update would shrink."""
    return extent_faults(published, new, allow_growth=True)


def state_coordinates(coords: DataFrame) -> DataFrame:
    """(coord): coordinates that a template leaves entirely null; jobs write them, and a template never overwrites them."""
    return coords.groupBy("coord").agg(F.count("value").alias("n")).where("n = 0").select("coord")


def refreshed_coordinates(published: DataFrame, template: DataFrame) -> DataFrame:
    """Coordinates after a template is written over a store: the template's, but for state coordinates, which stay as published."""
    state = state_coordinates(template)
    kept = published.join(state, "coord", "left_semi")
    fresh = template.join(kept.select("coord").distinct(), "coord", "left_anti")
    return fresh.select("coord", "index", "value").union(kept.select("coord", "index", "value"))


def refreshed_attributes(published: DataFrame, template: DataFrame) -> DataFrame:
    """(path, key, published, new) of the attributes that a refresh would change; no rows, nothing to commit."""
    a, b = (df.select("path", "key", F.col("value").alias(as_)) for df, as_ in ((published, "published"), (template, "new")))
    return a.join(b, ["path", "key"], "full").where(~F.col("published").eqNullSafe(F.col("new")))
