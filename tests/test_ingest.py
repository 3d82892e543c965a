from pyspark.sql import functions as F

from stratagrid.plans import ingest, spec
from stratagrid.sources import store

RAIN = spec.Variable("rain", rate="accumulated", reset=6 * 3600, keep_bits=10)
TEMPERATURE = spec.Variable("t", sentinel=-9999.0, factor=0.1, offset=-10.0)
DATASET = spec.Dataset("d", ("x",), "time", 0, 3600, 8, (RAIN, TEMPERATURE))


def cells(spark, hours):
    grid = spark.range(hours).select((F.col("id") * 3600).alias("time")).crossJoin(spark.range(3).select(F.col("id").alias("x")))
    rain = grid.select("x", "time", F.lit("rain").alias("var"), ((F.col("time") / 3600 + 5) % 6 * (F.col("x") + 1) * 360).alias("value"))
    t = grid.select("x", "time", F.lit("t").alias("var"), F.when(F.col("time") % 18000 == 0, -9999.0).otherwise(F.col("time") / 1000).alias("value"))
    return rain.union(t)


def rows(spark, root):
    return sorted((r.x, r.time, r["var"], r.value) for r in store.read(spark, root).collect())


def test_update_equals_backfill(spark, tmp_path):
    whole, parts = str(tmp_path / "whole"), str(tmp_path / "parts")
    ingest.backfill(cells(spark, 50), DATASET, [whole])
    ingest.update(cells(spark, 19), DATASET, [parts])
    late = cells(spark, 37).where("x <> 2 or time < 40000")  # a late source, which the window's next sweep brings
    ingest.update(late, DATASET, [parts])
    ingest.update(cells(spark, 37), DATASET, [parts], window=24 * 3600)
    ingest.update(cells(spark, 50), DATASET, [parts])
    assert rows(spark, parts) == rows(spark, whole)
    got = {(x, t, v): y for x, t, v, y in rows(spark, whole)}
    assert got[0, 0, "rain"] is None and abs(got[1, 2 * 3600, "rain"] - 0.2) < 1e-3
    assert got[0, 18000, "t"] is None and abs(got[0, 3600, "t"] + 9.64) < 1e-6


def test_update_after_a_gap_equals_backfill(spark, tmp_path):
    dataset = spec.Dataset("d", ("x",), "time", 0, 3600, 10, (spec.Variable("rain", rate="accumulated", clamp=None), spec.Variable("t")))
    missing = {0: {19}, 1: set(range(3, 29)), 2: {24}, 3: set(range(0, 27)), 4: set(range(22, 60))}
    rows_of = [(x, h * 3600, v, float(h * 3600)) for x in range(5) for h in range(45) if h not in missing[x] for v in ("rain", "t")]
    cells = spark.createDataFrame(rows_of, "x long, time long, var string, value double").repartition(6)
    whole, parts, late = (str(tmp_path / n) for n in ("whole", "parts", "late"))
    ingest.backfill(cells, dataset, [whole])
    ingest.backfill(cells, dataset, [parts], end=25 * 3600)
    ingest.update(cells.where("time < 40 * 3600"), dataset, [parts])
    ingest.update(cells, dataset, [parts])
    assert rows(spark, parts) == rows(spark, whole)
    ingest.backfill(cells, dataset, [late], start=23 * 3600)
    assert rows(spark, late) == [r for r in rows(spark, whole) if r[1] >= 20 * 3600]
    got = {(x, t // 3600): y for x, t, v, y in rows(spark, whole) if v == "rain"}
    assert got[0, 20] == 1.0 and got[1, 29] == 1.0 and got[3, 27] is None


def test_range_is_whole_regions(spark, tmp_path):
    root = str(tmp_path / "r")
    ingest.backfill(cells(spark, 50), DATASET, [root], start=20 * 3600, end=30 * 3600)
    ends = store.read(spark, root).agg(F.min("time"), F.max("time")).first()
    assert tuple(ends) == (16 * 3600, 29 * 3600)


def test_pending(spark, tmp_path):
    root = str(tmp_path / "r")
    wanted = cells(spark, 12).where("x = 0").select(F.concat(F.lit("f"), F.col("time").cast("string")).alias("file"), "x", "time", "var", (F.col("var") == "t").alias("first"))
    assert ingest.pending_files(wanted, DATASET, root, "first").count() == 12
    ingest.backfill(cells(spark, 8), DATASET, [root])
    left = {r.file for r in ingest.pending_files(wanted, DATASET, root, "first").collect()}
    assert left == {f"f{h * 3600}" for h in (0, 5, 8, 9, 10, 11)}  # hours 0 and 5 hold no value


def test_backfill_range():
    import pytest

    assert ingest.backfill_range(DATASET, 7300, None) == (0, 7200)
    assert ingest.backfill_range(DATASET, 99999, 7200, may_overwrite=True) == (0, 10800)
    with pytest.raises(store.GuardError):
        ingest.backfill_range(DATASET, 99999, 7200)
