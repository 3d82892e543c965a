"""Digests, prefixes, bitmaps, references, tagged places, publication and streams with state."""

import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from stratagrid.functions import scalar
from stratagrid.operators import align, stats
from stratagrid.plans import grid
from stratagrid.sources import index_files, store
from stratagrid.streaming import updates


def test_differences_by_digest(spark):
    rng = random.Random(11)
    rows = [(i, rng.choice(["a", None, "b"]), rng.choice([1.0, None])) for i in range(600)] + [(5, "twice", 1.0)] * 2 + [(None, None, None)]
    other = [r for r in rows if r[0] not in (7, 300)] + [(900, "new", 1.0), (5, "twice", 1.0)]
    other = [(i, "b" if i == 44 else s, v) for i, s, v in other]
    swapped = [(i, s, v) for i, s, v in other]
    a, b = (spark.createDataFrame(x, "k long, s string, v double").repartition(4) for x in (rows, swapped))
    got = align.differences_by_digest(a, b.select("v", "s", "k"), ["k"], F.floor(F.col("k") / 100), buckets=8)
    assert sorted(map(str, got.collect())) == sorted(map(str, align.differences(a, b).collect()))
    assert align.differences_by_digest(a, a, ["k"], F.floor(F.col("k") / 100)).isEmpty()
    # a null and a value that change places are told apart
    x, y = spark.createDataFrame([(1, None, "p")], "k long, s string, t string"), spark.createDataFrame([(1, "p", None)], "k long, s string, t string")
    assert align.differences_by_digest(x, y, ["k"], F.lit(0)).count() == 2


def test_longest_prefix(spark):
    places = ["s3://a/b/c", "s3://a/b", "s3://a", "gs://z", "", None, "s3://a/b/c"]
    prefixes = [("s3://a/", "x"), ("s3://a/b", "y"), ("s3://a/b", "w"), (None, "n"), ("s3://a/b/c/d", "q")]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(places)], "id int, loc string")
    got = align.longest_prefix(df, "loc", spark.createDataFrame(prefixes, "prefix string, kind string"), "prefix", ["kind"])
    assert {r.id: (r.prefix, r.kind) for r in got.collect()} == {0: ("s3://a/b", "w"), 1: ("s3://a/b", "w"), 2: (None, None), 3: (None, None), 4: (None, None), 5: (None, None), 6: ("s3://a/b", "w")}
    none = align.longest_prefix(df, "loc", spark.createDataFrame([], "prefix string"), "prefix")
    assert none.where("prefix is null").count() == len(places)


def test_completeness_by_bitmaps_is_that_of_pairs(spark):
    rng = random.Random(12)
    have = [(rng.choice([1, 2, 3]), rng.choice([0, 5, 40_000, -3, 2**40, 77])) for _ in range(40)] + [(1, None), (9, 12345), (None, 5)]
    present = spark.createDataFrame(have, "day long, item long")
    items = spark.createDataFrame([(0,), (5,), (40_000,), (-3,), (2**40,), (None,), (5,)], "item long")
    days = spark.createDataFrame([(1,), (2,), (3,), (4,)], "day long")
    want = stats.completeness(grid.product(days, items.where("item is not null").distinct()), present, ["day"], ["item"])
    got = stats.completeness_of_product(items, days, present, "day", "item")
    assert sorted(got.collect()) == sorted(want.collect())
    assert "CartesianProduct" not in got._jdf.queryExecution().toString()


def test_references_run_on_through_a_file(spark):
    parts = [("f", 1, 10), ("f", 2, 0), ("f", 3, 7), ("g", 1, 4), ("g", 2, None), ("g", 3, 5), ("h", 1, -1)]
    got = index_files.references(spark.createDataFrame(parts, "file string, message long, length long").repartition(3))
    assert sorted(map(tuple, got.collect())) == [("f", 1, 0, 10), ("f", 2, 10, 0), ("f", 3, 10, 7), ("g", 1, 0, 4)]


def test_references_need_no_python_for_each_part(spark):
    parts = spark.range(60_000).select((F.col("id") % 5).cast("string").alias("file"), F.col("id").alias("message"), F.when(F.col("id") != 40_000, F.col("id") % 3).alias("length"))
    odd = spark.createDataFrame([("end", 1, 2), ("end", 2, -1), ("end", 3, 2**63 - 1), ("end", 4, 2**63 - 1), (None, 1, 3), (None, 2, 4)], "file string, message long, length long")
    got = index_files.references(parts.unionByName(odd))
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()
    at, want = [0] * 5, [("end", 1, 0, 2), (None, 1, 0, 3), (None, 2, 3, 4)]
    for i in range(60_000):
        if i % 5 or i < 40_000:
            want.append((str(i % 5), i, at[i % 5], i % 3))
            at[i % 5] += i % 3
    assert set(map(tuple, got.collect())) == set(want) and got.count() == len(want)


def test_tagged_places_round_trip(spark):
    rows = [(dt.datetime(2024, 2, 29, 23, 59, 59, 123456), 90, "a\"b", 1.5), (None, -3600, None, None), (dt.datetime(1, 1, 1), 0, "", -2.5)]
    df = spark.createDataFrame(rows, "at timestamp_ntz, lead long, name string, x double")
    text = scalar.tagged_place({"at": ("ts", F.col("at")), "lead": ("td", F.col("lead")), "name": ("plain", F.col("name")), "x": ("plain", F.col("x"))})
    back = df.select(text.alias("j")).select(*(c.alias(n) for n, c in zip("at lead name x".split(), scalar.untagged("j", {"at": "ts", "lead": "td", "name": "string", "x": "double"}))))
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    odd = ["{}", "no json", None, '{"at":{"__t":"zz","v":"2024-01-01T00:00:00"}}', '{"at":"2024-01-01"}', '{"at":{"__t":"ts","v":"never"}}', "[1]"]
    got = spark.createDataFrame([(x,) for x in odd], "j string").select(*scalar.untagged("j", {"at": "ts"}))
    assert [r[0] for r in got.collect()] == [None] * len(odd)
    with pytest.raises(ValueError):
        scalar.tagged_place({"a": ("what", F.lit(1))})


def test_a_failed_publication_keeps_the_old_table(spark, tmp_path):
    root, replica = str(tmp_path / "p"), str(tmp_path / "r")
    df = spark.range(40).select("id", F.floor(F.col("id") / 10).alias("region"))
    seen = spark.sparkContext.accumulator(0)
    store.publish(df, [root, replica], "region", "id")
    bad = df.withColumn("id", F.when(F.col("id") == 35, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        store.publish(bad, [root, replica], "region", "id")
    assert store.read(spark, root).count() == store.read(spark, replica).count() == 40

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    # evaluated once for the guards and all roots; regions that are gone go last; the table itself may be an input
    more = store.read(spark, root).where("region <> 1").select("id", F.col("region").cast("long").alias("region")).mapInArrow(count, "id long, region long")
    store.publish(more, [root, replica], "region", "id")
    assert seen.value == 30
    for r in (root, replica):
        assert sorted(x.id for x in store.read(spark, r).collect()) == [*range(10), *range(20, 40)]


def test_state_of_late_and_repeated_files(spark, tmp_path):
    hour = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    batches = [[("a", 100), ("b", 100), ("a", 100)], [("a", 100), ("c", 95), ("late", 91), ("n", None)], [("c", 95), ("old", 80), ("d", 120)], [("a", 100), ("b", 100), ("older", 80), ("e", 121)]]
    folder = str(tmp_path / "in")
    schema = "k string, at timestamp"

    def run():
        updates.append_within(updates.read_files(spark, folder, schema), str(tmp_path / "out"), str(tmp_path / "state"), ["k", "at"], "at", "10 hours").awaitTermination()
        return sorted(r.k for r in spark.read.parquet(str(tmp_path / "out")).collect())

    for i, batch in enumerate(batches):
        spark.createDataFrame([(k, hour(h) if h is not None else None) for k, h in batch], schema).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(0.05)
        if i == 1:
            assert run() == ["a", "b", "c", "late"]  # and the state outlives the query
    assert run() == run() == ["a", "b", "c", "d", "e", "late"]


def test_progress_rows(spark, tmp_path):
    log = updates.Progress()
    spark.streams.addListener(log)
    try:
        spark.range(10).repartition(2).write.parquet(str(tmp_path / "in"))
        stream = updates.read_files(spark, str(tmp_path / "in"), "id long").observe("seen", F.count(F.lit(1)).alias("n"))
        q = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        q.awaitTermination()
        rows = log.rows(q).where("input_rows > 0").collect()
    finally:
        spark.streams.removeListener(log)
    assert sum(r.input_rows for r in rows) == 10 and len(rows) == 2 and all('"n"' in r.observed["seen"] for r in rows)
