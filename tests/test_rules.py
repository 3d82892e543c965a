"""Request shards, region plans, listing rules, the recent-missing check and range joins without a width."""

import pytest
from pyspark.sql import functions as F

from stratagrid.operators import align, checks
from stratagrid.plans import grid
from stratagrid.sources import index_files


def test_no_batch_is_over_its_bytes(spark):
    rows = [("g", f"v{i:02d}", n) for i, n in enumerate([5, 5, 7, 1, 5, 5])] + [("big", "a", 99), ("big", "b", 1), ("none", "x", None), ("none", "y", 0)]
    df = spark.createDataFrame(rows + rows[:2], "g string, v string, n long")
    got = grid.batches_by_bytes(df, ["g"], "v", "n", 15).collect()
    assert len(got) == len(rows)
    sizes = {}
    for r in got:
        sizes.setdefault((r.g, r.batch), []).append(r.n or 0)
    assert all(sum(x) <= 15 or len(x) == 1 for x in sizes.values())
    assert sorted(len(v) for k, v in sizes.items() if k[0] == "g") == [2, 2, 2] and len(sizes["none", 0]) == 2


def test_region_faults(spark):
    df = spark.createDataFrame([(0.0, 4.0), (None, 3.0), (2.0, None), (1.5, 3.0), (-1.0, 3.0), (3.0, 3.0)], "start double, stop double")
    assert [r.fault for r in grid.region_faults(df).orderBy(F.monotonically_increasing_id()).collect()] == ["open", "open", "not whole", "negative", "empty"]


def test_first_rule_that_fits_decides(spark):
    paths = ["/a/x.bz2", "/a/pressure-level/x.bz2", "/a/pressure-levels/y.txt", "x.bz2", "/a/b/c.txt", "/top.txt", None]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    kept = lambda *rules: [r.p for r in index_files.filtered(df, "p", list(rules)).collect()]
    assert kept("- **/pressure-level*/**", "+ *.bz2", "- **") == ["/a/x.bz2", "x.bz2"]
    assert kept("+ *.bz2", "- **pressure-level**", "- **") == ["/a/x.bz2", "/a/pressure-level/x.bz2", "x.bz2"]
    assert kept("- /*.txt") == [p for p in paths if p and p != "/top.txt"]
    assert kept() == [p for p in paths if p]
    with pytest.raises(ValueError):
        kept("* x")


def test_recent_missing_without_hour_0_and_sampled(spark):
    rows = [(d, h, None if h == 0 or (d == 7 and h < 3) else 1.0) for d in range(10) for h in range(4)]
    df = spark.createDataFrame(rows, "day long, h long, v double")
    check = lambda **kw: checks.recent_missing(df, "day", "v", [1.0, 0.1], **kw).first()
    assert not check().passed  # a quarter is missing
    assert check(no_hour_0=F.col("h") == 0).passed  # in the two newest
    wide = check(no_hour_0=F.col("h") == 0, window=10)
    assert (wide.passed, wide.message, wide.checked) == (False, "1 positions over their limit", 9)
    few = {check(no_hour_0=F.col("h") == 0, window=10, sampled=2, seed=s).passed for s in range(12)}
    assert few == {True, False}
    assert check(window=10, sampled=3, no_hour_0=F.lit(True)).passed
    assert not checks.recent_missing(df.where("day = 1"), "day", "v", [1.0, 1.0]).first().passed


def test_many_ranges_go_by_buckets(spark, monkeypatch):
    monkeypatch.setattr(align, "FEW_RANGES", 5)
    left = spark.range(100).select(F.col("id").alias("at"))
    ranges = spark.createDataFrame([(i * 10, i * 10 + 10, i) for i in range(9)] + [(None, 3, 100), (97, None, 101)], "lo long, hi long, r long")
    got = sorted((x.at, -1 if x.r is None else x.r) for x in align.range_join(left, ranges, "at", "lo", "hi").collect())
    want = sorted((i, r) for i in range(100) for r in ([i // 10] if i < 90 else []) + ([100] if i < 3 else []) + ([101] if i >= 97 else []) + ([-1] if 90 <= i < 97 else []))
    assert got == want
    with pytest.raises(ValueError):
        align.range_join(left.select(F.lit("x").alias("at")), ranges.select(*(F.col(c).cast("string").alias(c) for c in ranges.columns)), "at", "lo", "hi")
