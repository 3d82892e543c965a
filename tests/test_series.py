import numpy as np
import pytest
from pyspark.sql import functions as F

from stratagrid.functions import scalar
from stratagrid.operators import align, checks, segments, series
from stratagrid.plans import spec


def rates(spark, rows, **kw):
    df = spark.createDataFrame([("s", *r) for r in rows], "k string, t long, v double, skip boolean")
    out = series.deaccumulate(df, ["k"], "t", "v", **kw).orderBy("t").collect()
    return [r.rate for r in out], [r.clamped for r in out], [r.invalid for r in out]


def test_reset_and_first(spark):
    got, _, _ = rates(spark, [(0, 1.0, False), (10, 3.0, False), (20, 7.0, False), (30, 2.0, False)], reset=20)
    assert got == [None, 0.3, 0.4, 0.2]  # after 0 and 20 the baseline is 0


def test_skipped_rows_are_invisible(spark):
    got, _, _ = rates(spark, [(5, 1.0, True), (10, 99.0, True), (15, 4.0, False)], reset=None, skip="skip")
    assert got == [None, 99.0, pytest.approx(0.3)]


def test_clamp_and_invalid(spark):
    got, clamped, invalid = rates(spark, [(1, 1.0, False), (2, 0.99, False), (3, 0.49, False), (4, None, False), (5, 1.0, False)], clamp=-0.5)
    assert got == [None, 0.0, None, None, None]
    assert clamped == [False, True, False, False, False] and invalid == [False, False, True, False, False]


def test_signed_and_ties(spark):
    got, _, _ = rates(spark, [(1, 3.0, False), (3, 1.0, False), (3, 1.0, False)], mode="signed")
    assert got == [None, -1.0, None]


def test_interpolation_ends_and_missing_neighbours(spark):
    df = spark.createDataFrame([("s", 0, 1.0, True), ("s", 1, 9.0, True), ("s", 2, 5.0, False), ("s", 3, 7.0, True), ("s", 4, None, False), ("s", 5, 2.0, True)], "k string, t long, v double, f boolean")
    assert [r.filled for r in series.interpolate_flagged(df, ["k"], "t", "v", "f").orderBy("t").collect()] == [1.0, 3.0, 5.0, None, None, 2.0]


def _gappy(spark, n, missing, skipped):
    rows = [(k, i, i * 10, float(i * i % 97), i in skipped) for k in ("s", None) for i in range(n) if i not in missing]
    return spark.createDataFrame(rows, "k string, i long, t long, v double, skip boolean").repartition(5)


@pytest.mark.parametrize("missing, skipped, mode", [((9,), (), "signed"), ((19, 20, 21, 30), (), "running_mean"), ((), (9, 19, 20), "accumulated"), (tuple(range(10, 31)), (9, 31, 40), "accumulated"), ((5,), tuple(range(0, 30)), "accumulated")])
def test_cut_series_equal_whole_ones(spark, missing, skipped, mode):
    df = _gappy(spark, 50, missing, skipped)
    kw = {"reset": 100, "skip": "skip", "mode": mode, "clamp": -3.0}
    cols = ["k", "i", "rate", "clamped", "invalid"]
    whole = sorted(map(str, series.deaccumulate(df, ["k"], "t", "v", **kw).select(*cols).collect()))
    cut = series.deaccumulate(df, ["k"], "t", "v", region=F.floor(F.col("i") / 10), **kw)
    halo = segments.trim_halo(series.deaccumulate(segments.with_halo(df, ["k"], "i", 10, skip="skip"), ["k", "region"], "t", "v", **kw))
    assert sorted(map(str, cut.select(*cols).collect())) == whole
    assert sorted(map(str, halo.select(*cols).collect())) == whole


def test_halos_of_several_rows_on_both_sides(spark):
    df = _gappy(spark, 60, (18, 19, *range(30, 40), 41), (8, 9, 40))
    order = [r.i for r in df.where("k = 's'").orderBy("i").collect()]
    got = segments.with_halo(df, ["k"], "i", 10, before=3, after=2)
    for region in {i // 10 for i in order}:
        own = [i for i in order if i // 10 == region]
        want = [i for i in order if i < own[0]][-3:] + own + [i for i in order if i > own[-1]][:2]
        assert [r.i for r in got.where(f"k = 's' and region = {region}").orderBy("i").collect()] == want
    live = segments.with_halo(df, ["k"], "i", 10, before=2, skip="skip")
    assert [r.i for r in live.where("k = 's' and region = 5 and not own").orderBy("i").collect()] == [48, 49]
    assert [r.i for r in live.where("k = 's' and region = 1 and not own").orderBy("i").collect()] == [6, 7]


def test_sums_and_followers_across_regions(spark):
    rows = [(k, t, v) for k in ("s", None) for t, v in [(1, 5), (3, None), (9, 2), (9, 4), (31, 1), (77, 7), (78, 1)]]
    df = spark.createDataFrame(rows, "k string, t long, v long").repartition(4)
    region = F.floor(F.col("t") / 10)
    sums = [(r.t, r.s) for r in segments.running_sum(df, ["k"], "t", "v", region, "s").where("k is null").orderBy("t").collect()]
    assert sums == [(1, 5), (3, 5), (9, 11), (9, 11), (31, 12), (77, 19), (78, 20)]
    after = [(r.t, r.a) for r in segments.following(df, ["k"], "t", region, "a").where("k = 's'").orderBy("t").collect()]
    assert after == [(1, 3), (3, 9), (9, 31), (9, 31), (31, 77), (77, 78), (78, None)]
    assert segments.running_sum(df.where("k = 's'").drop("k"), [], "t", "v", region, "s").agg(F.max("s")).first()[0] == 20


def test_interpolation_with_halos_equals_whole(spark):
    df = _gappy(spark, 40, (9, 20), ()).withColumn("flag", F.col("i") % 5 == 0)
    whole = {(r.k, r.i): r.filled for r in series.interpolate_flagged(df, ["k"], "i", "v", "flag").collect()}
    parts = segments.trim_halo(series.interpolate_flagged(segments.with_halo(df, ["k"], "i", 10, before=1, after=1), ["k", "region"], "i", "v", "flag"))
    assert {(r.k, r.i): r.filled for r in parts.collect()} == whole


def test_round_mantissa_against_bits(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 32, 3000, dtype=np.uint32).view(np.float32)
    x = np.r_[x[np.isfinite(x)], np.float32([0, 1, -1, 1.5, 3.4028235e38, 1e-45, 2**-126])].astype(np.float32)
    for k in (1, 7, 12, 22):
        bits = x.view(np.uint32).astype(np.uint64)
        drop = np.uint64(23 - k)
        half, odd = (np.uint64(1) << drop) >> np.uint64(1), (bits >> drop) & np.uint64(1)
        want = (((bits + half - np.uint64(1) + odd) >> drop) << drop).astype(np.uint32).view(np.float32)
        df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "i long, v double")
        got = np.array([r.r for r in df.select("i", scalar.round_mantissa("v", k).alias("r")).orderBy("i").collect()], dtype=np.float32)
        assert (got == want).all()


def test_nearest_ties_and_tolerance(spark):
    l = spark.createDataFrame([(1, "a", 10), (2, "a", 100), (3, "b", 5), (4, "a", 14)], "id long, k string, t long")
    r = spark.createDataFrame([("a", 8, "early"), ("a", 12, "late"), ("a", 12, "later"), ("a", 16, "end")], "k string, rt long, name string")
    got = {x.id: x.name for x in align.nearest(l, r, ["k"], "t", "rt", ["name"], tolerance=50).collect()}
    assert got == {1: "late", 2: None, 3: None, 4: "end"}


def test_checks_and_report(spark):
    df = spark.createDataFrame([(d, None if d == 3 else 1.0) for d in range(5)], "day long, v double")
    good = checks.recent_missing(df, "day", "v", [0.0])
    bad = checks.recent_missing(df, "day", "v", [0.0, 0.5])
    short = checks.recent_missing(df, "day", "v", [1.0] * 9)
    assert [x.collect()[0].passed for x in (good, bad, short)] == [True, False, False]
    found = checks.report([good, bad]).collect()
    assert len({r.fingerprint for r in found}) == 1
    with pytest.raises(ValueError):
        checks.strictly_selected(["a"], ["b"], [])
    with pytest.raises(ValueError):
        checks.strictly_selected(["a"], None, ["a"])


def test_overwrite_guard():
    v = spec.Variable("t")
    old = spec.Dataset("d", ("x",), "time", 0, 3600, 24, (v,))
    assert spec.overwrite_guard(old, old) == []
    new = spec.Dataset("d", ("x",), "time", 0, 3600, 24, (v, spec.Variable("u")))
    assert spec.overwrite_guard(old, new) == ["u is new"] and spec.overwrite_guard(old, new, allow_new_variables=True) == []
    assert spec.overwrite_guard(new, old, allow_new_variables=True) == ["u is gone"]
    assert "instead of 9" in spec.overwrite_guard(old, old, allow_growth=True, published_end=9, new_end=5)[0]
    assert "grow to 12" in spec.overwrite_guard(old, old, published_end=9, new_end=12)[0]
    assert spec.overwrite_guard(old, old, allow_growth=True, published_end=9, new_end=12) == spec.overwrite_guard(old, old, published_end=9, new_end=9) == []


def test_range_join_by_buckets(spark):
    rng = np.random.default_rng(3)
    left = spark.createDataFrame([(i, int(t)) for i, t in enumerate(rng.integers(-200, 3000, 300))], "id long, t long")
    starts = rng.integers(-100, 2500, 80)
    rows = [(k, int(s), int(s + n)) for k, (s, n) in enumerate(zip(starts, rng.integers(0, 600, 80)))] + [(900, None, -50), (901, 2900, None), (902, 5000, 6000)]
    ranges = spark.createDataFrame(rows, "name long, a long, b long")
    got = [sorted((r.id, r.name or -1) for r in align.range_join(left, ranges, "t", "a", "b", width=w).collect()) for w in (None, 100, 7)]
    assert got[0] == got[1] == got[2] and len(got[0]) > 300
    many = align.range_join(left, spark.range(10_001).selectExpr("id as name", "id as a", "id + 1 as b"), "t", "a", "b")
    assert {r.name for r in many.collect() if r.t >= 0} == {r.t for r in left.collect() if r.t >= 0}


def test_contiguous_across_stretches(spark):
    """Gaps in, at and over the ends of stretches, in each series."""
    for missing in ({4096}, {4000}, {4095, 4096}, set(range(3000, 9000)), {0}):
        steps = [i for i in range(10_000) if i not in missing]
        want = sorted((b, b - a) for a, b in zip(steps, steps[1:]) if b - a != 1)
        df = spark.createDataFrame([(i, "x") for i in steps], "t long, k string")
        assert sorted((r.t, r.gap) for r in series.contiguous(df.select("t"), "t", 1).collect()) == want
        two = df.union(spark.range(5000).selectExpr("id", "'y'"))
        assert sorted((r.k, r.t, r.gap) for r in series.contiguous(two, "t", 1, ["k"]).collect()) == [("x", *w) for w in want]


def test_constant_fill_is_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (-9999.0,), (2.0,)], "v double")
    assert [r[0] for r in df.select(series.nulls(scalar.mask_sentinel("v", -9999.0))).collect()] == [None, None, 2.0]


def test_nearest_with_tolerance_equals_without(spark):
    rng = np.random.default_rng(7)
    l = spark.createDataFrame([(i, "k", int(t)) for i, t in enumerate(rng.integers(-500, 3000, 300))], "id long, k string, t long")
    r = spark.createDataFrame([("k", int(t), int(t)) for t in rng.integers(-500, 3000, 200)], "k string, rt long, found long")
    whole = {x.id: x.found if x.found is not None and abs(x.found - x.t) <= 3 else None for x in align.nearest(l, r, ["k"], "t", "rt", ["found"]).collect()}
    assert {x.id: x.found for x in align.nearest(l, r, ["k"], "t", "rt", ["found"], tolerance=3).collect()} == whole


def test_followers_of_a_long_series_in_one_pass(spark):
    df = spark.range(0, 2_000_000, 7).select(F.lit("s").alias("k"), F.col("id").alias("t")).repartition(3)
    got = segments.following(df, ["k"], "t", F.lit(0), "a")  # frames that reach to the end took a time that grows with the square
    assert "UNBOUNDEDFOLLOWING" not in got._jdf.queryExecution().executedPlan().toString().upper().replace(" ", "")
    assert got.where("coalesce(a, 2000005) <> t + 7").count() == 0 and got.where("a is null").count() == 1
