"""The nearest cell of a grid in two dimensions, by boxes within boxes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.store import written

#: Bits of the finest squares along the longer side, and those that a step goes down.
BITS, STEP = 20, 2
#: Boxes that every place starts with, and cells of a box that is not cut further, both at most.
FEW, MOST = 64, 32
#: A bound is taken as larger or smaller by this share, which is far more than rounding errs.
SLACK = 1e-9


def planar(lat: Column, lon: Column, to_lat: Column, to_lon: Column) -> Column:
    """Squared equirectangular distance in degrees, seen from (lat, lon)."""
    dx = (to_lon - lon) * F.cos(F.radians(lat))
    return (to_lat - lat) * (to_lat - lat) + dx * dx


def nearest_cell_2d(points: DataFrame, cells: DataFrame, index: list[str], lat: str = "lat", lon: str = "lon") -> DataFrame:
    """`points` with the `index` of the cell nearest to each, ties by the smallest index; NULL without cells or a finite place.

    Both have columns `lat` and `lon`, in degrees, longitudes on one branch. Cells stand
    in squares whose sides are halved, each with the box that its cells span. Every
    distinct place starts with few large boxes and goes down from those that may hold its
    nearest cell: their nearest edge is no further than the furthest corner of any. Boxes
    of at most `MOST` cells (or the finest) are compared cell by cell. So neither empty
    squares nor the shape of the grid cost anything, and a place meets few cells.
    """
    finite = lambda c: F.abs(F.col(c).cast("double")) < float("inf")
    known = cells.where(finite(lat) & finite(lon)).groupBy(F.col(lat).cast("double").alias("__a"), F.col(lon).cast("double").alias("__o")).agg(F.min(F.struct(*index)).alias("__i"))
    south, north, west, east = known.agg(F.min("__a"), F.max("__a"), F.min("__o"), F.max("__o")).first()
    if south is None:
        return points.select(*points.columns, *(F.lit(None).cast(cells.schema[c].dataType).alias(c) for c in index))
    width = max(north - south, east - west) / (1 << BITS) or 1.0
    square = lambda c, origin: F.floor((F.col(c) - origin) / width).cast("long")
    known = written(known.withColumns({"__y": square("__a", south), "__x": square("__o", west)}), "nearest-cells")
    start, last = _levels(known)

    places = points.where(finite(lat) & finite(lon)).select(F.col(lat).cast("double").alias("__la"), F.col(lon).cast("double").alias("__lo")).distinct()
    left = _nearer(places.crossJoin(F.broadcast(_boxes(known, start))))  # FEW boxes
    for level in range(start - STEP, last - 1, -STEP):
        inner = _boxes(known, level).withColumns({"__py": F.shiftright("__y", STEP), "__px": F.shiftright("__x", STEP)})
        outer = left.select("__la", "__lo", F.col("__y").alias("__py"), F.col("__x").alias("__px"))
        left = _nearer(outer.join(inner, ["__py", "__px"]).drop("__py", "__px"))
    cell = known.select("__a", "__o", "__i", F.shiftright("__y", last).alias("__y"), F.shiftright("__x", last).alias("__x"))
    d = planar(F.col("__la"), F.col("__lo"), F.col("__a"), F.col("__o"))
    best = left.join(cell, ["__y", "__x"]).groupBy("__la", "__lo").agg(F.min(F.struct(d.alias("d"), "__i")).alias("__best"))
    best = best.select("__la", "__lo", *(F.col("__best.__i")[c].alias(f"__i_{c}") for c in index))
    same = (F.col(lat).cast("double") == F.col("__la")) & (F.col(lon).cast("double") == F.col("__lo"))
    return points.join(best, same, "left").select(*points.columns, *(F.col(f"__i_{c}").alias(c) for c in index))


def _levels(known: DataFrame) -> tuple[int, int]:
    """The level with at most `FEW` boxes that places start with, and the one whose boxes have at most `MOST` cells, or the finest."""
    at = known.withColumn("__k", F.explode(F.array(*(F.lit(k) for k in range(0, BITS + STEP + 1, STEP)))))
    n = at.groupBy("__k", F.expr("shiftright(__y, __k)"), F.expr("shiftright(__x, __k)")).agg(F.count("*").alias("n"))
    sizes = n.groupBy("__k").agg(F.count("*").alias("boxes"), F.max("n").alias("most")).collect()  # a row a level
    start = min(r["__k"] for r in sizes if r.boxes <= FEW)
    return start, min(start, max((r["__k"] for r in sizes if r.most <= MOST), default=0))


def _boxes(known: DataFrame, level: int) -> DataFrame:
    """(__y, __x) of the squares of a level that have cells, with what these span."""
    ends = [f(c).alias(n) for c, least, most in (("__a", "__south", "__north"), ("__o", "__west", "__east")) for f, n in ((F.min, least), (F.max, most))]
    return known.groupBy(F.shiftright("__y", level).alias("__y"), F.shiftright("__x", level).alias("__x")).agg(*ends)


def _nearer(left: DataFrame) -> DataFrame:
    """(__la, __lo, __y, __x) of the boxes that may hold a place's nearest cell."""
    lo, hi = [], []
    for at, least, most in (("__la", "__south", "__north"), ("__lo", "__west", "__east")):
        before, behind = F.col(least) - F.col(at), F.col(at) - F.col(most)
        scale = F.cos(F.radians(F.col("__la"))) if at == "__lo" else F.lit(1.0)
        near, far = F.greatest(before, behind, F.lit(0.0)) * scale, F.greatest(F.abs(before), F.abs(behind)) * scale
        lo.append(near * near)
        hi.append(far * far)
    bounds = left.withColumns({"__near": lo[0] + lo[1], "__far": hi[0] + hi[1]})
    reach = F.min("__far").over(Window.partitionBy("__la", "__lo"))  # some boxes a place
    return bounds.withColumn("__reach", reach).where(F.col("__near") * (1 - SLACK) <= F.col("__reach") * (1 + SLACK)).select("__la", "__lo", "__y", "__x")
