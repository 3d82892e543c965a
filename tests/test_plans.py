import itertools
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from stratagrid.functions import scalar
from stratagrid.operators import align, series, stats
from stratagrid.plans import grid, layout, spec
from stratagrid.queries import QUERIES, SQL
from stratagrid.sources import index_files
from stratagrid.streaming import updates


@pytest.mark.parametrize(("n", "workers"), [(1, 1), (7, 3), (64, 5), (33, 8)])
def test_assignment_covers_all_jobs(spark, n, workers):
    jobs = spark.range(n).select(F.col("id").alias("job"))
    spread = Counter(r.worker for r in grid.assign(jobs, "job", workers).collect())
    assert sum(spread.values()) == n and max(spread.values()) - min(spread.values()) <= 1
    blocks = [r.worker for r in grid.assign(jobs, "job", workers, "contiguous").orderBy("job").collect()]
    assert blocks == sorted(blocks) and max(Counter(blocks).values()) == -(-n // workers)


def test_spread_prefixes_cover_the_range(spark):
    order = [r.job for r in spark.range(16).select(F.col("id").alias("job"), grid.bit_reversal(F.col("id"), 16).alias("k")).orderBy("k").collect()]
    assert order[:4] == [0, 8, 4, 12] and sorted(order) == list(range(16))


def test_evenly_spaced():
    assert grid.evenly_spaced(10, 4) == [0, 3, 6, 9] and grid.evenly_spaced(3, 9) == [0, 1, 2] and grid.evenly_spaced(0, 3) == [] and grid.evenly_spaced(5, 1) == [0]


def test_regions(spark):
    axis = spark.range(23).select(F.col("id").alias("i"), (F.col("id") * 10).alias("label"))
    assert [tuple(r) for r in grid.regions(axis, "i", 10).orderBy("region").collect()] == [(0, 0, 10), (1, 10, 20), (2, 20, 23)]
    assert [r.region for r in grid.regions_between(axis, "i", "label", 10, 190, 200).collect()] == [1]
    assert grid.regions_containing(axis, "i", "label", 10, axis.where("false")).count() == 0


def test_layout(spark):
    shape = {"time": 720, "latitude": 721, "longitude": 1440}
    chunk = layout.chunk_shapes(spark, shape, ("latitude", "longitude")).first().asDict()
    chunk = {d: chunk[d] for d in shape}
    shards = layout.shard_shapes(spark, shape, chunk, ("latitude", "longitude")).collect()
    assert 0 < len(shards) <= 10 and all(r[d] % chunk[d] == 0 for r in shards for d in shape) and all(100 <= r.mb <= 1200 for r in shards)
    cost = layout.access_cost(layout.chunk_shapes(spark, shape), shape, ("latitude", "longitude"), "time").first()
    assert cost.slice_mb >= cost.mb and cost.series_mb >= cost.mb
    assert spark.range(1).select(layout.evenness(100, F.lit(25)), layout.evenness(100, F.lit(99))).first()[0] == 1.0


def test_contiguous_and_tiers(spark):
    df = spark.createDataFrame([(0,), (60,), (120,), (300,)], "t long")
    assert [(r.t, r.gap) for r in series.contiguous(df, "t", 60).collect()] == [(300, 180)]
    assert [r.limit for r in series.recency_tier(df, "t", [0.5, 1.0]).orderBy("t").collect()] == [1.0, 1.0, 1.0, 0.5]
    due = spark.range(1).select(series.due_position(F.lit(1000), F.lit(0), 300, 150), series.due_position(F.lit(10), F.lit(0), 300, 150)).first()
    assert tuple(due) == (600, None)


def test_lookup(spark):
    index = spark.createDataFrame([("f", "TMP", 0), ("f", "TMP", 9), ("f", "RH", 20)], "file string, element string, start long")
    wanted = spark.createDataFrame([("t", "TMP"), ("t_max", "TMP"), ("gust", "GUST")], "var string, element string")
    found = index_files.lookup(index, wanted, ["element"])
    assert found.count() == 4 and {r["var"] for r in index_files.lookup_faults(found, wanted, "file", "var").collect()} == {"t", "t_max"}
    ranges = index_files.byte_ranges(index, "file", "start", F.lit(50).cast("long")).withColumn("x", F.lit(1))
    refs = index_files.refs(ranges.withColumnRenamed("element", "v"), "v", ["x"], "file").orderBy("offset").collect()
    assert [(r.offset, r.length) for r in refs] == [(0, 9), (9, 11), (20, 30)]


def test_availability_and_pending(spark):
    d = spec.Dataset("d", ("x",), "time", 0, 10, 5, (spec.Variable("a"), spec.Variable("b", since=100)))
    assert [v.name for v in d.available(99)] == ["a"] and [v.name for v in d.available(100)] == ["a", "b"]
    assert d.schema().fieldNames() == ["x", "time", "var", "value"]
    e, p, l = (spark.createDataFrame([(i,) for i in x], "k long") for x in ([1, 2, 3], [1], [2, 9, 9]))
    assert [r.k for r in updates.pending(e, p, l, ["k"]).collect()] == [2]


def test_small_functions(spark):
    row = spark.range(1).select(
        scalar.pascal_case(F.lit("some wind-forecast")),
        *scalar.dataset_and_version(F.lit("s3://b/some-data/v0.2.0.zarr/")),
        *scalar.split_var_path(F.lit("pressure/level/t")),
        scalar.signed_magnitude(F.lit(0x8003), 16),
        align.nearest_level(F.lit(10.0), [5.0, 15.0]),
        scalar.whole_hours(F.lit(5400)),
    ).first()
    assert tuple(row) == ("SomeWindForecast", "some-data", "v0.2.0", "pressure/level", "t", -3, 15.0, None)
    with pytest.raises(ValueError):
        scalar.round_mantissa("x", 24)


def test_histogram_edges(spark):
    one = stats.histogram(spark.createDataFrame([(2.0,), (2.0,), (None,)], "v double"), "v").collect()
    assert [(r.bin, r.n, r.density) for r in one] == [(0, 2, None)]
    many = {r.bin: r.n for r in stats.histogram(spark.range(11).select(F.col("id").cast("double").alias("v")), "v", 10).collect()}
    assert many == {**{b: 1 for b in range(9)}, 9: 2}


def test_shards_are_shared_evenly_without_joins(spark):
    got = grid.shards_of_shape(spark, {"t": 7, "y": 100, "x": 31}, {"t": 3, "y": 9, "x": 10})
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString() and "Cartesian" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.columns == ["t", "y", "x"] and dict(got.dtypes) == {"t": "bigint", "y": "bigint", "x": "bigint"}
    assert sorted(map(tuple, got.collect())) == [(t, y, x) for t in range(3) for y in range(12) for x in range(4)]
    sizes = got.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert max(sizes) - min(sizes) <= 1
    assert grid.shards_of_shape(spark, {"t": 5, "y": 0, "x": 2}, {"t": 2, "y": 1, "x": 1}).count() == 0


def test_shards_take_little_room_however_long_the_axes(spark, tmp_path):
    got = grid.shards_of_shape(spark, {"t": 7, "y": 50, "x": 6000}, {"t": 1, "y": 1, "x": 1})
    got.write.parquet(str(tmp_path / "shards"))
    assert sum(f.stat().st_size for f in (tmp_path / "shards").glob("*.parquet")) < 0.25 * 7 * 50 * 6000
    for shape in ({"t": 3, "y": 37, "x": 41}, {"a": 33, "b": 17}, {"id": 50}, {"a": 16, "b": 1, "c": 16}, {"a": 2, "b": 20, "c": 5, "d": 18}):
        got = grid.shards_of_shape(spark, shape, dict.fromkeys(shape, 1))
        assert got.columns == list(shape) and {t for _, t in got.dtypes} == {"bigint"}
        assert sorted(map(tuple, got.collect())) == list(itertools.product(*map(range, shape.values()))), shape


def test_orders_without_a_date_are_no_day(spark, tmp_path):
    duck = duckdb.connect()
    duck.execute("create table orders as select d::timestamp as o_orderdate from (select date '1995-01-01' + i::int d from range(30) g(i) union all select null)")
    duck.execute("create table supplier as select 1 as s_suppkey")
    duck.execute("create table customer as select i as c_custkey from range(26) g(i)")
    for name in ("orders", "supplier", "customer"):
        duck.execute(f"copy {name} to '{tmp_path}/{name}.parquet' (format parquet)")
    want = sorted(duck.execute(f"select t, y, x from ({SQL['shard_product']})").fetchall())
    assert sorted((r.t, r.y, r.x) for r in QUERIES["shard_product"](spark, str(tmp_path)).collect()) == want == [(0, 0, 0), (0, 0, 1)]
