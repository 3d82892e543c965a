import random

import pytest
from pyspark.sql import functions as F

from stratagrid.operators import align, quantile, ranges, spatial, stats


def test_ranges_share_the_rows(spark):
    df = spark.range(1000).select((F.col("id") * F.col("id")).alias("v"))
    cuts = ranges.splitters(df, "v", 8)
    got = {r.p: r["count"] for r in df.select(ranges.range_of(F.col("v"), cuts).alias("p")).groupBy("p").count().collect()}
    assert set(got) == set(range(8)) and max(got.values()) < 160
    for v, want in ((None, 0), (cuts[3], 4), (cuts[3] - 1, 3), (-5, 0), (10**9, len(cuts))):
        assert spark.range(1).select(ranges.range_of(F.lit(v).cast("long"), cuts).alias("p")).first().p == want
    assert ranges.splitters(df.where("v < 0"), "v", 8) == [] and ranges.range_of(F.lit(1), []) is not None


def nearest_plain(left, right):
    for i, k, t in left:
        best = min(((abs(rt - t), -rt, name) for rk, rt, name in right if rk == k), default=None)
        yield i, best[2] if best else None


def test_nearest_of_one_hot_key_is_cut(spark):
    rng = random.Random(8)
    left = [(i, rng.choice(["hot"] * 9 + ["cold", "none", None]), rng.randint(0, 10_000)) for i in range(700)]
    right = [(rng.choice(["hot"] * 9 + ["cold", None]), t, f"n{rng.randint(0, 99):02d}") for t in rng.choices(range(4000, 6000), k=150) for _ in range(2)]
    l = spark.createDataFrame(left, "id long, k string, t long").repartition(5)
    r = spark.createDataFrame(right, "k string, rt long, name string").repartition(3)
    joined = align.nearest(l, r, ["k"], "t", "rt", ["name"], ranges=16)
    assert sorted((x.id, x.name) for x in joined.collect()) == sorted(nearest_plain(left, right))
    none = align.nearest(l, r.where("false"), ["k"], "t", "rt", ["name"], ranges=16)
    assert {x.name for x in none.collect()} == {None} and none.count() == 700


@pytest.mark.parametrize("most, n", [(1 << 20, 256), (20, 8)])
def test_quantiles_by_selection(spark, most, n):
    rng = random.Random(9)
    rows = [("even", float(i)) for i in range(400)] + [("ties", 7.0)] * 150 + [("ties", 1.0), ("one", 3.5), ("none", None), (None, 2.0), (None, 4.0)] + [("skew", rng.lognormvariate(0, 5)) for _ in range(300)] + [("even", None)] * 3
    df = spark.createDataFrame(rows, "k string, v double").repartition(4)
    shares = {"p0": 0.0, "p33": 0.33, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    want = {r.k: tuple(r[1:]) for r in df.groupBy("k").agg(*(F.percentile("v", s).alias(name) for name, s in shares.items())).collect()}
    got = {r.k: tuple(r[1:]) for r in quantile.quantiles(df, ["k"], "v", shares, most, n).collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == (pytest.approx(want[k], rel=1e-12) if want[k][0] is not None else want[k])


def test_quantiles_of_everything_and_of_nothing(spark):
    df = spark.range(101).select(F.col("id").alias("v"))
    assert tuple(stats.quantiles(df, [], "v", {"m": 0.5}).first()) == (50.0,)
    assert tuple(stats.quantiles(df.where("v < 0"), [], "v", {"m": 0.5}).first()) == (None,)


def test_nearest_grid_cell(spark):
    rng = random.Random(10)
    cells = [(y, x, 30 + 0.3 * y + 0.05 * x, -100 + 0.4 * x - 0.07 * y) for y in range(12) for x in range(15)] + [(50, 50, 30.0, -100.0), (51, 0, None, 1.0)]
    points = [(i, rng.uniform(25, 40), rng.uniform(-110, -90)) for i in range(60)] + [(100, 30.0, -100.0), (101, 89.9, 170.0), (102, None, 3.0), (103, 31.0, -99.0), (104, 31.0, -99.0), (105, -90.0, 0.0)]
    import math

    def plain(lat, lon):
        if lat is None:
            return None
        return min((((a - lat) ** 2 + ((o - lon) * math.cos(math.radians(lat))) ** 2, (y, x)) for y, x, a, o in cells if a is not None))[1]

    grid = spark.createDataFrame(cells, "y int, x int, lat double, lon double").repartition(3)
    p = spark.createDataFrame(points, "id int, lat double, lon double").repartition(3)
    got = spatial.nearest_cell_2d(p, grid, ["y", "x"])
    assert {r.id: (r.y, r.x) if r.y is not None else None for r in got.collect()} == {i: plain(a, o) for i, a, o in points}
    assert got.count() == len(points)
    assert spatial.nearest_cell_2d(p, grid.where("false"), ["y", "x"]).where("y is null").count() == len(points)


def test_nearest_cell_of_a_thin_grid_with_a_dense_spot(spark):
    import math

    rng = random.Random(11)
    nan, inf = float("nan"), float("inf")
    cells = [(y, x, 20 + 0.25 * y, -120 + 0.5 * x - 0.0625 * y) for y in range(1500) for x in range(3)]
    cells += [(2000 + i, 0, 40 + rng.random() * 1e-3, -119 + rng.random() * 1e-3) for i in range(2000)] + [(5000 - i, 7, 25.0, -100.0) for i in range(300)]
    points = [(i, rng.uniform(20, 60), rng.uniform(-125, -110)) for i in range(60)] + [(100, 40.0005, -118.9995), (101, 25.1, -100.2), (102, 90.0, 0.0), (103, -89.0, 400.0)]
    odd = [(200, nan, 1.0), (201, 1.0, inf), (202, None, 1.0)]

    def plain(lat, lon):
        return min((((a - lat) ** 2 + ((o - lon) * math.cos(math.radians(lat))) ** 2, (y, x)) for y, x, a, o in cells))[1]

    grid = spark.createDataFrame(cells + [(0, 0, nan, nan), (0, 1, 30.0, inf)], "y int, x int, lat double, lon double").repartition(3)
    got = spatial.nearest_cell_2d(spark.createDataFrame(points + odd, "id int, lat double, lon double").repartition(3), grid, ["y", "x"])
    assert {r.id: (r.y, r.x) for r in got.collect()} == {i: plain(a, o) for i, a, o in points} | {i: (None, None) for i, *_ in odd}
    squares = spark.createDataFrame([(int((a - 20) / 4000 * (1 << 20)), int((o + 300) / 4000 * (1 << 20)), a, o, 0) for _, _, a, o in cells[:4500]], "__y long, __x long, __a double, __o double, __i int")
    start, last = spatial._levels(squares)
    assert spatial._boxes(squares, start).count() <= spatial.FEW and squares.groupBy(F.shiftright("__y", last), F.shiftright("__x", last)).count().agg(F.max("count")).first()[0] <= spatial.MOST
