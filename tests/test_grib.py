import bz2
import gzip
import struct
import zlib

import numpy as np
import pytest

from stratagrid.sources import grib


def section(n, body):
    return struct.pack(">IB", len(body) + 5, n) + body


def message(values, d=1, bits=12, kind=0, lead=6, member=0, bitmap=None, category=1, level=2):
    x = np.round(np.array(values, dtype=float) * 10**d).astype(int)
    reference = int(x.min())
    packed = np.array([[(v - reference) >> (bits - 1 - i) & 1 for i in range(bits)] for v in x], dtype=np.uint8).ravel()
    n = len(values) if bitmap is None else len(bitmap)
    grid = section(3, bytes(25) + struct.pack(">II", n, 1) + bytes(34))
    product = bytearray(60)
    product[2:4] = kind.to_bytes(2, "big")
    product[4], product[5], product[12], product[17] = category, 3, 1, 103
    product[13:17] = lead.to_bytes(4, "big")
    product[19:23] = level.to_bytes(4, "big")
    product[30] = member
    if kind in (8, 11):
        base = (34 if kind == 8 else 37) - 5
        product[base + 14] = 1
        product[base + 15 : base + 19] = (3).to_bytes(4, "big")
    packing = section(5, struct.pack(">IHf", len(values), 0, reference) + bytes([0, 0]) + struct.pack(">H", d if d >= 0 else 0x8000 - d) + bytes([bits, 0]))
    bits_ = section(6, bytes([255])) if bitmap is None else section(6, bytes([0]) + np.packbits(bitmap).tobytes())
    body = section(1, bytes(16)) + grid + section(4, bytes(product)) + packing + bits_ + section(7, np.packbits(packed).tobytes()) + b"7777"
    return b"GRIB" + bytes([0, 0, 0, 2]) + struct.pack(">Q", 16 + len(body)) + body


def test_fields(spark, tmp_path):
    one, two = [1.5, -2.0, 300.1], [7.0, 8.0]
    (tmp_path / "a.grib2").write_bytes(message(one) + message(two, kind=11, member=5, bitmap=[1, 0, 1]))
    rows = grib.read_fields(spark, str(tmp_path)).orderBy("message").collect()
    assert [round(v, 3) for v in rows[0]["values"]] == one and rows[1]["values"] == [7.0, None, 8.0]
    assert [(r.category, r.number, r.surface, r.level, r.lead_hours, r.member, r.decimal_scale) for r in rows] == [(1, 3, 103, 2.0, 6, 0, 1), (1, 3, 103, 2.0, 9, 5, 1)]
    catalogue = spark.createDataFrame([("t", 0, 1, 3, None, None), ("u", 0, 1, 3, 103, 2.0), ("v", 0, 9, 9, None, None)], "var string, discipline long, category long, number long, surface long, level double")
    named = grib.with_variables(grib.read_fields(spark, str(tmp_path)), catalogue)
    assert named.count() == 4 and grib.cells(named).count() == 12
    assert grib.scale_faults(grib.read_fields(spark, str(tmp_path)), 1).count() == 0
    assert grib.scale_faults(grib.read_fields(spark, str(tmp_path)), 2).count() == 2
    (tmp_path / "b.grib2").write_bytes(message(one)[:-2])
    rows = grib.read_fields(spark, str(tmp_path)).collect()  # a bad file leaves the others
    assert sorted((r.file[-7:], r.error is None) for r in rows) == [("a.grib2", True), ("a.grib2", True), ("b.grib2", False)]
    assert "no whole message" in next(r.error for r in rows if r.error)
    (tmp_path / "c.grib2.gz").write_bytes(gzip.compress(message(one)))
    (tmp_path / "d.grib2.bz2").write_bytes(bz2.compress(message(one)))
    (tmp_path / "e.gz").write_bytes(gzip.compress(message(one))[:-9])
    got = {r.file.rpartition("/")[2]: (r.error is None, r["values"]) for r in grib.read_fields(spark, str(tmp_path)).collect()}
    assert got["c.grib2.gz"] == got["d.grib2.bz2"] and got["c.grib2.gz"][0] and not got["e.gz"][0]


def bits_of(x, size):
    return [x >> (size - 1 - i) & 1 for i in range(size)]


def as_bytes(bits):
    return np.packbits(np.array(bits, dtype=np.uint8)).tobytes()


def packed_as(x, order, missing=()):
    """Complex packing of integers by hand: groups of five, spatial differencing of the order, `missing` places left out."""
    there = [v for i, v in enumerate(x) if i not in missing]
    diffs, first = list(there), there[:order]
    for _ in range(order):
        diffs = [b - a for a, b in zip(diffs, diffs[1:])]
    lowest = min(diffs) if order else 0
    d = iter([0] * order + [v - lowest for v in diffs])
    values = [None if i in missing else next(d) for i in range(len(x))]
    groups = [values[i : i + 5] for i in range(0, len(values), 5)]
    bases = [min((v for v in g if v is not None), default=0) for g in groups]
    widths = [max((v - b for v in g if v is not None), default=0).bit_length() + 1 for g, b in zip(groups, bases)]
    size = max(max(bases).bit_length(), 1) + 1
    magnitude = lambda v: (abs(v) | (0x8000 if v < 0 else 0)).to_bytes(2, "big")
    body = b"".join(magnitude(v) for v in [*first, lowest]) if order else b""
    for row, n in ((bases, size), ([w - 1 for w in widths], 4), ([0] * len(groups), 3)):
        body += as_bytes([b for v in row for b in bits_of(v, n)])
    body += as_bytes([b for g, base, w in zip(groups, bases, widths) for v in g for b in bits_of((1 << w) - 1 if v is None else v - base, w)])
    head = struct.pack(">IHf", len(x), 3 if order else 2, 0.0) + bytes(4) + bytes([size, 0, 1, 1 if missing else 0]) + bytes(8)
    head += struct.pack(">IBBIBIB", len(groups), 1, 4, 5, 1, len(groups[-1]), 3) + (bytes([order, 2]) if order else b"")
    return head, body


@pytest.mark.parametrize("order", [0, 1, 2])
@pytest.mark.parametrize("missing", [(), (0, 7, 8), (3,)])
def test_complex_packing(order, missing):
    rng = np.random.default_rng(order)
    x = np.cumsum(rng.integers(-9, 12, 23)) + (200 if not order else 0)
    x = x.tolist()
    head, body = packed_as(x, order, missing)
    got = grib.complex_values(section(5, head), body, order > 0)
    assert [None if v != v else int(v) for v in got] == [None if i in missing else v for i, v in enumerate(x)]


def png(pixels, depth, kinds):
    """A grey image whose lines use the filters in turn."""
    height, size = pixels.shape[0], depth // 8
    raw = pixels.astype(f">u{size}").view(np.uint8).reshape(height, -1).astype(int)
    out = b""
    for y, line in enumerate(raw):
        up = raw[y - 1] if y else np.zeros_like(line)
        left, corner = (np.r_[np.zeros(size, int), v[:-size]] for v in (line, up))
        p = left + up - corner
        a, b, c = abs(p - left), abs(p - up), abs(p - corner)
        guess = [0, left, up, (left + up) // 2, np.where((a <= b) & (a <= c), left, np.where(b <= c, up, corner))][kinds[y % len(kinds)]]
        out += bytes([kinds[y % len(kinds)]]) + ((line - guess) % 256).astype(np.uint8).tobytes()
    chunk = lambda k, v: struct.pack(">I", len(v)) + k + v + struct.pack(">I", zlib.crc32(k + v))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", pixels.shape[1], height, depth, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(out)) + chunk(b"IEND", b"")


@pytest.mark.parametrize("depth", [8, 16])
def test_png_packing(depth):
    pixels = np.random.default_rng(1).integers(0, 1 << depth, (12, 9))
    for kinds in ([0], [1], [2], [3], [4], [0, 1, 2, 3, 4]):
        assert grib.png_values(png(pixels, depth, kinds)).tolist() == pixels.ravel().tolist()


def test_packings_of_messages(spark, tmp_path):
    x = [5, 9, 12, 20, 19, 3, 7, 8, 8, 30, 31]
    plain = message([1.0] * len(x))
    parts = grib.sections(plain)
    for name, (head, body) in {"two": packed_as(x, 0), "three": packed_as(x, 2), "png": (struct.pack(">IHf", len(x), 41, 0.0) + bytes(4) + bytes([8, 0]), png(np.array([x]), 8, [1]))}.items():
        content = parts[1] + parts[3] + parts[4] + section(5, head) + parts[6] + section(7, body) + b"7777"
        (tmp_path / name).write_bytes(plain[:8] + struct.pack(">Q", 16 + len(content)) + content)
    got = {r.file.rpartition("/")[2]: (r.packing, r["values"]) for r in grib.read_fields(spark, str(tmp_path)).collect()}
    assert got == {"two": (2, x), "three": (3, x), "png": (41, x)}


def test_stack(spark):
    cells = spark.createDataFrame([("f", 0, 500.0, 1.0), ("f", 0, 850.0, 2.0), ("f", 1, 850.0, 3.0), ("f", 1, 10.0, 9.0)], "file string, x long, level double, value double")
    assert [(r.x, r["values"]) for r in grib.stacked(cells, [850, 700, 500], ["file", "x"]).orderBy("x").collect()] == [(0, [2.0, None, 1.0]), (1, [3.0, None, None])]


def test_numbers():
    assert grib.signed(bytes([0x80, 3])) == -3 and grib.signed(bytes([0, 3])) == 3
    assert grib.unpack(bytes([0b10110100]), 3, 2).tolist() == [5, 5] and grib.unpack(b"", 0, 2).tolist() == [0, 0]
