import struct

import pytest
from pyspark.sql import functions as F

from stratagrid.functions import raster
from stratagrid.sources import index_files, store
from stratagrid.streaming import updates


def test_text_index_and_ranges(spark, tmp_path):
    (tmp_path / "a.idx").write_text("1:0:d=2024010100:TMP:2 m above ground:anl:\n2:50:d=2024010100:UGRD:10 m:6 hour fcst:\n3:50:d=2024010100:VGRD:10 m:6 hour fcst:\n4:90:d=2024010100:APCP:surface:0-6 hour acc fcst:\nnoise\n")
    got = index_files.byte_ranges(index_files.text_index(spark, str(tmp_path)), "file", "start").orderBy("message").collect()
    assert [(r.start, r.stop, r.element) for r in got] == [(0, 50, "TMP"), (50, 90, "UGRD"), (50, 90, "VGRD"), (90, 90 + index_files.PAD, "APCP")]
    assert got[0].init == "2024010100" and got[3].period == "0-6 hour acc fcst"


def test_json_index(spark, tmp_path):
    (tmp_path / "a.index").write_text('{"param":"2t","levtype":"sfc","step":"6","number":"3","_offset":10,"_length":5}\n{"param":"t","levtype":"pl","levelist":"850","step":"6","_offset":15,"_length":7}\n')
    got = index_files.json_index(spark, str(tmp_path)).orderBy("start").collect()
    assert [(r.param, r.number, r.levelist, r.start, r.stop) for r in got] == [("2t", 3, None, 10, 15), ("t", 0, 850.0, 15, 22)]


def frame(body: bytes) -> bytes:
    size = 16 + len(body) + 4
    return b"GRIB" + bytes([0, 0, 0, 2]) + struct.pack(">Q", size) + body + b"7777"


def test_message_frames(spark, tmp_path):
    (tmp_path / "x.bin").write_bytes(frame(b"abc") + frame(b"defgh"))
    got = index_files.message_frames(spark, str(tmp_path)).orderBy("message").collect()
    assert [(r.message, r.start, r.length) for r in got] == [(0, 0, 23), (1, 23, 25)]
    (tmp_path / "y.bin").write_bytes(frame(b"abc") + frame(b"abc")[:-1] + b"8")
    (tmp_path / "z.bin").write_bytes(b"junk" * 9)
    got = [(r.file[-5:], r.message, r.error) for r in index_files.message_frames(spark, str(tmp_path)).orderBy("file", "message").collect()]
    assert got == [("x.bin", 0, None), ("x.bin", 1, None), ("y.bin", 0, None), ("y.bin", 1, "the message has no end"), ("z.bin", 0, "no message starts here")]


def test_lookup_by_patterns(spark):
    index = spark.createDataFrame([("f", 1, "TMP", "2 m above ground", "anl"), ("f", 2, "TMP", "surface", "anl"), ("f", 3, "APCP", "surface", "0-6 hour acc fcst"), ("g", 1, "TEMP", "2 m above ground", "6 hour fcst")], "file string, message int, element string, level string, period string")
    wanted = spark.createDataFrame([("t2m", "TMP|TEMP", "2 m above ground", None), ("rain", "APCP", "surface", r"0-\d+ hour acc.*")], "var string, element string, level string, period string")
    found = index_files.lookup(index, wanted, ["level", "element", "period"], ["element", "period"])
    assert sorted((r.file, r.message, r.var) for r in found.collect()) == [("f", 1, "t2m"), ("f", 3, "rain"), ("g", 1, "t2m")]
    assert [(r.file, r.var, r.n) for r in index_files.lookup_faults(found, wanted, "file", "var", index).collect()] == [("g", "rain", 0)]


def test_stale_file(spark):
    df = spark.createDataFrame([("a", 0, 5, 10), ("a", 5, 11, 10), ("b", 0, 10, 10)], "f string, start long, stop long, size long")
    assert [r.f for r in index_files.drop_stale_files(df, "f", "size").collect()] == ["b"]


def test_publish_and_guards(spark, tmp_path):
    primary, replica = str(tmp_path / "p"), str(tmp_path / "r")
    df = spark.range(10).select(F.col("id").alias("time"), F.lit(1.0).alias("v"), (F.col("id") % 2).cast("int").alias("region"))
    assert store.resume_point(spark, primary, "region", "time", 0) == 0 and store.read(spark, primary) is None
    store.publish(df, [primary, replica], "region", "time", salt=F.col("time") % 3)
    assert store.read(spark, primary).count() == store.read(spark, replica).count() == 10
    assert store.read(spark, primary).dtypes == df.dtypes
    with pytest.raises(store.GuardError, match="shrink"):
        store.publish(df.where("time < 5"), [primary], "region", "time")
    with pytest.raises(store.GuardError, match="missing"):
        store.publish(df.drop("v"), [primary], "region", "time")
    with pytest.raises(store.GuardError, match="empty"):
        store.publish(df.where("false"), [primary], "region", "time")
    fresh = spark.range(8, 12).select(F.col("id").alias("time"), F.lit(2.0).alias("v"), F.lit(1).cast("int").alias("region"))
    store.publish(fresh, [primary, replica], "region", "time", only_regions=True)
    for root in (primary, replica):  # region 0 stays, region 1 is replaced
        assert store.read(spark, root).where("v = 2.0").count() == 4 and store.read(spark, root).count() == 9
    assert store.resume_point(spark, primary, "region", "time", 0) == 11


def test_new_rows_prunes(spark, tmp_path):
    target = str(tmp_path / "t")
    rows = spark.range(40).select((F.col("id") % 4).alias("p"), F.col("id").alias("k"))
    assert updates.new_rows(rows, target, ["p", "k"], ["p"]).count() == 40
    rows.where("k < 30").write.partitionBy("p").parquet(target)
    assert sorted(r.k for r in updates.new_rows(rows.where("p = 1"), target, ["p", "k"], ["p"]).collect()) == [33, 37]


def test_stream_is_idempotent(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    rows = spark.range(100).select((F.col("id") % 30).alias("k"), F.col("id").alias("v"))
    rows.repartition(5).write.parquet(source)
    for run in ("one", "two"):  # the second run starts over, as after a lost checkpoint
        stream = updates.read_files(spark, source, rows.schema)
        updates.append_once(stream, target, str(tmp_path / run), ["k"]).awaitTermination()
    assert spark.read.parquet(target).count() == 30
    assert not updates.deadline_reached(0, 60, 100) and updates.deadline_reached(0, 70, 100)


def test_windowed_stats(spark, tmp_path):
    source = str(tmp_path / "in")
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    df.coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(df.schema).parquet(source)
    updates.windowed_stats(stream, "ts", ["event_type"], "value").writeStream.outputMode("complete").format("memory").queryName("w").trigger(availableNow=True).start().awaitTermination()
    batch = df.groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count("*").alias("n"))
    assert spark.table("w").agg(F.sum("n"), F.count("*")).first() == batch.agg(F.sum("n"), F.count("*")).first()


def test_raster(spark):
    cells = spark.createDataFrame([(y, x, float(10 * y + x) if (y, x) != (1, 1) else None) for y in range(3) for x in range(4)], "y long, x long, value double")
    fine = {(r.y, r.x): r.value for r in raster.refine(cells, [], 2, 4, 3).collect()}
    assert len(fine) == 5 * 8 and fine[0, 0] == 0.0 and fine[0, 1] == 0.5 and fine[0, 7] == 1.5 and fine[2, 2] is None and fine[4, 4] == 22.0
    lat, lon = raster.lambert_inverse(F.lit(0.0), F.lit(0.0), 38.5, -97.5, 38.5, 38.5)
    got = spark.range(1).select(lat, lon).first()
    assert got[0] == pytest.approx(38.5) and got[1] == pytest.approx(-97.5)


def test_json_sink_and_gzip(spark, tmp_path):
    import gzip

    df = spark.createDataFrame([("t", 5, None), ("u", 7, "x")], "var string, offset long, a string")
    index_files.write_json_index(df.coalesce(1), str(tmp_path / "out"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect()) == ['{"a":"x","offset":7,"var":"u"}', '{"offset":5,"var":"t"}']
    (tmp_path / "z").mkdir()
    (tmp_path / "z" / "a.idx.gz").write_bytes(gzip.compress(b"1:0:d=2024010100:TMP:surface:anl:\n"))
    assert index_files.text_index(spark, str(tmp_path / "z")).first().element == "TMP"


def test_markdown(spark):
    from stratagrid.operators import checks

    results = spark.createDataFrame([("b", True, "fine", 3), ("a", False, "x|y", 4)], "check string, passed boolean, message string, checked long")
    lines = [r.line for r in checks.markdown(results).orderBy("order").collect()]
    assert lines == ["| check | result | message | checked |", "| --- | --- | --- | --- |", "| a | FAILED | x/y | 4 |", "| b | passed | fine | 3 |"]


def test_ranges_of_a_file_of_many_small_messages(spark):
    index = spark.range(300_000).select(F.lit("a").alias("file"), (F.floor(F.col("id") / 2) * 3).alias("start"))  # one stretch, two parts a start
    got = index_files.byte_ranges(index, "file", "start", F.lit(450_001))
    assert "UNBOUNDEDFOLLOWING" not in got._jdf.queryExecution().executedPlan().toString().upper().replace(" ", "")
    assert got.count() == 300_000 and got.where("stop <> if(start = 449997, 450001, start + 3)").count() == 0
