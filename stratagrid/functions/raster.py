"""Raster functions: cells are rows (keys, y, x, value)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A spherical earth of 6,371,229 m, as in many weather models.
EARTH_RADIUS = 6_371_229.0


def flip_transpose(cells: DataFrame, height: int) -> DataFrame:
    """The rows and columns of a (y, x) field exchanged, then its rows reversed; `height` is the new number of rows."""
    return cells.withColumns({"y": F.lit(height - 1) - F.col("x"), "x": F.col("y")})


def refine(cells: DataFrame, keys: list[str], factor: int, width: int, height: int, wrap: bool = True) -> DataFrame:
    """Bilinear interpolation to a grid `factor` times as fine; source points are kept as they are.

    Each source cell is sent to the fine points around it with its weights, and these
    are summed: one expansion and one aggregation, no join. With `wrap` the last column
    neighbours the first; without, and at the last row, the fine grid ends at the last point.
    """
    rows, cols = (height - 1) * factor + 1, width * factor if wrap else (width - 1) * factor + 1
    off = F.array(*(F.lit(i) for i in range(1 - factor, factor)))
    spread = cells.select(*keys, "y", "x", "value", F.explode(off).alias("dy")).select("*", F.explode(off).alias("dx"))
    fine_x = F.pmod(F.col("x") * factor + F.col("dx"), F.lit(cols)) if wrap else F.col("x") * factor + F.col("dx")
    spread = spread.withColumns({"fy": F.col("y") * factor + F.col("dy"), "fx": fine_x, "w": (factor - F.abs("dy")) * (factor - F.abs("dx"))})
    spread = spread.where(F.col("fy").between(0, rows - 1) & F.col("fx").between(0, cols - 1))
    missing = F.max(F.col("value").isNull().cast("int"))
    g = spread.groupBy(*keys, F.col("fy").alias("y"), F.col("fx").alias("x")).agg((F.sum(F.col("value") * F.col("w")) / (factor * factor)).alias("v"), missing.alias("m"))
    return g.select(*keys, "y", "x", F.when(F.col("m") == 0, F.col("v")).alias("value"))


def pixel_centre(index: Column, edge: float, step: float) -> Column:
    return F.lit(edge) + step / 2 + index * step


def lambert_inverse(x: Column, y: Column, lat0: float, lon0: float, lat1: float, lat2: float, radius: float = EARTH_RADIUS) -> tuple[Column, Column]:
    """(latitude, longitude) in degrees of metres of a conformal conic projection on a sphere."""
    p0, p1, p2 = (math.radians(v) for v in (lat0, lat1, lat2))
    t = lambda p: math.tan(math.pi / 4 + p / 2)
    n = math.sin(p1) if lat1 == lat2 else math.log(math.cos(p1) / math.cos(p2)) / math.log(t(p2) / t(p1))
    f = math.cos(p1) * t(p1) ** n / n
    rho0 = radius * f / t(p0) ** n
    rho = F.sqrt(x * x + F.pow(rho0 - y, F.lit(2))) * math.copysign(1, n)
    theta = F.atan2(x, rho0 - y) if n > 0 else F.atan2(-x, y - rho0)
    lat = F.degrees(2 * F.atan(F.pow(radius * f / rho, F.lit(1 / n)))) - 90
    return lat, F.degrees(theta / n) + lon0


def cylindrical_inverse(x: Column, y: Column, true_lat: float = 30.0, radius: float = 6_371_228.0) -> tuple[Column, Column]:
    """(latitude, longitude) in degrees of metres of an equal-area cylindrical projection on a sphere."""
    c = math.cos(math.radians(true_lat))
    return F.degrees(F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), y * c / radius)))), F.degrees(x / (radius * c))
