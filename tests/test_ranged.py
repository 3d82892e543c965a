import random
import struct

from pyspark.sql import functions as F

from stratagrid.sources import index_files, ranged


def message(payload: bytes, discipline: int) -> bytes:
    return b"GRIB\0\0" + bytes([discipline, 2]) + struct.pack(">Q", 20 + len(payload)) + payload + b"7777"


def test_a_file_of_many_messages_is_read_by_several_tasks(spark, tmp_path):
    rng = random.Random(13)
    folder = tmp_path / "in"
    folder.mkdir()
    for name in ("a", "b"):
        parts = [message(rng.randbytes(rng.randint(0, 900)) + rng.choice([b"", b"GRIB", b"7777GRIB\0\0\0\2" + b"\0" * 7 + b"\x20"]), rng.randint(0, 9)) for _ in range(120)]
        (folder / name).write_bytes(b"".join(parts))
    (folder / "empty").write_bytes(b"")
    whole = index_files.message_frames(spark, str(folder)).withColumn("file", F.regexp_extract("file", "[^/]+$", 0))
    want = sorted(map(tuple, whole.select("file", "message", "start", "length", "discipline", "error").collect()))
    for n in (1000, 4096, 77, 1 << 20):
        cut = ranged.message_ranges(spark, str(folder), n)
        got = ranged.numbered(cut).withColumn("file", F.regexp_extract("file", "[^/]+$", 0))
        assert sorted(map(tuple, got.collect())) == want
    assert ranged.message_ranges(spark, str(folder), 4096).rdd.getNumPartitions() > 20


def test_a_broken_file_goes_on_at_the_next_range_and_filters_prune(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    good = b"".join(message(b"x" * 80, i) for i in range(20))
    (folder / "broken").write_bytes(good[:250] + b"?" * 40 + good[300:])
    (folder / "good").write_bytes(good)
    got = ranged.message_ranges(spark, str(folder), 500)
    rows = got.where(F.col("file").endswith("broken")).orderBy("start").collect()
    assert [r.start for r in rows if r.error] == [200] and {r.start for r in rows if not r.error and r.start >= 500}
    one = got.where(F.col("file") == str(folder / "good"))
    assert one.count() == 20 and one.rdd.getNumPartitions() == 4


def test_many_small_ranges_share_tasks(spark, tmp_path):
    rng = random.Random(14)
    folder = tmp_path / "in"
    folder.mkdir()
    for name in "abc":
        parts = [message(rng.randbytes(rng.choice([5, 60, 60, 20_000, 70_000])) + rng.choice([b"", b"GRIB"]), rng.randint(0, 255)) for _ in range(60)]
        (folder / name).write_bytes(b"".join(parts))
    blob = (folder / "c").read_bytes()
    (folder / "c").write_bytes(blob[: len(blob) // 2] + b"?" * 30 + blob[len(blob) // 2 + 30 :])
    few = ranged.message_ranges(spark, str(folder), 1 << 10)
    assert sum(-(-f.stat().st_size // 1024) for f in folder.iterdir()) > 2000 and 64 <= few.rdd.getNumPartitions() < 100
    reader = ranged.FramedReader({"path": str(folder), "rangebytes": "1024"})
    alone = [r for t in reader.partitions() for path, size, a, z in t.pieces for k in range(a, z) for b in reader.read(ranged.Ranges(0, [(path, size, k, k + 1)])) for r in map(tuple, zip(*b.to_pydict().values()))]
    assert sorted(map(str, map(tuple, few.collect()))) == sorted(map(str, alone))
    whole = {tuple(r) for r in index_files.message_frames(spark, str(folder)).where("error is null").selectExpr("right(file, 1)", "start", "length", "discipline").collect()}
    assert whole <= {(r.file[-1], r.start, r.length, r.discipline) for r in few.collect()}
