"""Fields of GRIB edition 2 files: identity, packing and values of every message.

Files are read with Spark's binaryFile source (so a file has 2 GB at most), compressed
ones (gzip, bzip2) too; each message becomes one row. Simple packing (template 5.0),
complex packing with and without spatial differencing (5.2, 5.3) and PNG (5.41) are
decoded, with or without a bitmap; of other packings only identity and packing are
given and `values` is NULL. A message that can't be read becomes a row with `error`,
after which its file is left; other files go on.
"""

from __future__ import annotations

import bz2
import gzip
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FIELDS = "file string, message long, start long, length long, discipline long, category long, number long, surface long, level double, lead_hours long, member long, nx long, ny long, reference double, binary_scale long, decimal_scale long, bits long, packing long, values array<float>, error string"
NAMES = [x.split()[0] for x in FIELDS.split(", ")]
#: Hours of the units of forecast time that hours can express: hour, 3, 6 and 12 hours, day.
UNIT_HOURS = {1: 1, 10: 3, 11: 6, 12: 12, 2: 24}
ENSEMBLE, INTERVAL = (1, 11), (8, 11)


def signed(raw: bytes) -> int:
    """Sign and magnitude, most significant byte first."""
    n = int.from_bytes(raw, "big")
    top = 1 << (8 * len(raw) - 1)
    return -(n - top) if n & top else n


def sections(message: bytes) -> dict[int, bytes]:
    found, at = {}, 16
    while message[at : at + 4] != b"7777":
        size = struct.unpack(">I", message[at : at + 4])[0]
        if size < 5 or at + size > len(message) - 4:
            raise ValueError("a section overruns its message")
        found[message[at + 4]] = message[at : at + size]
        at += size
    return found


def unpack(raw: bytes, bits: int, count: int) -> np.ndarray:
    """`count` unsigned integers of `bits` bits each."""
    if bits == 0:
        return np.zeros(count)
    if bits in (8, 16, 32):
        return np.frombuffer(raw, dtype=f">u{bits // 8}", count=count).astype(float)
    flat = np.unpackbits(np.frombuffer(raw, dtype=np.uint8), count=bits * count).reshape(count, bits)
    return flat @ (2.0 ** np.arange(bits - 1, -1, -1))


def extract(raw: bytes, start: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Unsigned integers of up to 56 bits each that start at the given bits."""
    padded = np.zeros(len(raw) + 8, dtype=np.uint8)
    padded[: len(raw)] = np.frombuffer(raw, dtype=np.uint8)
    eight = np.ndarray(len(raw) + 1, ">u8", padded, strides=(1,))[np.minimum(start >> 3, len(raw))].astype(np.uint64)
    bits = bits.astype(np.uint64)
    shifted = (eight << (start & 7).astype(np.uint64)) >> (np.uint64(64) - np.maximum(bits, np.uint64(1)))
    return np.where(bits > 0, shifted, np.uint64(0)).astype(np.int64)


def complex_values(packing: bytes, data: bytes, differenced: bool) -> np.ndarray:
    """Packed integers of groups of their own width, NaN where missing; `data` is a section's body."""
    bits, missing = packing[19], packing[22]
    groups, least_width, width_bits, least_length, step, last, length_bits = struct.unpack(">IBBIBIB", packing[31:47])
    at, first, lowest = 0, [], 0
    if differenced:
        order, octets = packing[47], packing[48]
        extra = [signed(data[i * octets : (i + 1) * octets]) for i in range(order + 1)]
        at, first, lowest = (order + 1) * octets, extra[:order], extra[order]

    def table(size: int) -> np.ndarray:
        nonlocal at
        found = extract(data[at:], np.arange(groups) * size, np.full(groups, size))
        at += -(-groups * size // 8)
        return found

    base, width, length = table(bits), table(width_bits) + least_width, table(length_bits) * step + least_length
    length[-1:] = last
    widths = np.repeat(width, length)
    ends = np.cumsum(widths)
    low = extract(data[at:], ends - widths, widths)
    x = (np.repeat(base, length) + low).astype(float)
    if missing:
        full = np.where(widths > 0, (1 << widths) - 1, (1 << bits) - 1)
        seen = np.where(widths > 0, low, np.repeat(base, length))
        x[(seen == full) | ((missing == 2) & (seen == full - 1))] = np.nan
    if differenced:
        there = np.flatnonzero(~np.isnan(x))
        d = x[there] + lowest
        d[: len(first)] = first[: len(d)]
        if len(first) == 2 and len(d) > 1:  # second differences: their sums are first differences
            d[1:] = np.cumsum(np.r_[d[1] - d[0], d[2:]])
        x[there] = np.cumsum(d)
    return x


def png_values(data: bytes) -> np.ndarray:
    """Pixels of a PNG image as integers, most significant byte first; not interlaced."""
    at, parts, head = 8, [], b""
    while at + 8 <= len(data):
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        body = data[at + 8 : at + 8 + size]
        if kind == b"IHDR":
            head = body
        elif kind == b"IDAT":
            parts.append(body)
        at += 12 + size
    width, height, depth, colour = struct.unpack(">IIBB", head[:10])
    channels = {0: 1, 2: 3, 4: 2, 6: 4}[colour]
    reach, line = max(1, depth * channels // 8), -(-width * depth * channels // 8)
    raw = np.frombuffer(zlib.decompress(b"".join(parts)), dtype=np.uint8).reshape(height, line + 1)
    rows, above = np.zeros((height, line), dtype=np.uint8), np.zeros(line, dtype=np.uint8)
    for y, (kind, x) in enumerate(zip(raw[:, 0].tolist(), raw[:, 1:])):
        if kind == 1:
            whole = np.zeros(-(-line // reach) * reach, dtype=np.uint8)
            whole[:line] = x
            x = np.cumsum(whole.reshape(-1, reach), axis=0, dtype=np.uint8).ravel()[:line]
        elif kind == 2:
            x = x + above
        elif kind in (3, 4):
            x = np.array(_unfiltered(kind, x.tolist(), above.tolist(), reach), dtype=np.uint8)
        rows[y] = above = x
    if depth < 8:
        return unpack(rows.tobytes(), depth, height * (line * 8 // depth)).reshape(height, -1)[:, :width].ravel()
    size = depth * channels // 8
    return rows.reshape(-1, size).astype(float) @ (256.0 ** np.arange(size - 1, -1, -1))


def _unfiltered(kind: int, x: list[int], above: list[int], reach: int) -> list[int]:
    """A line of the filters that need the byte before: average (3) and nearest of three (4)."""
    for i in range(len(x)):
        left, up, corner = (x[i - reach], above[i], above[i - reach]) if i >= reach else (0, above[i], 0)
        if kind == 3:
            guess = (left + up) // 2
        else:
            to_left, to_up, to_corner = abs(up - corner), abs(left - corner), abs(left + up - 2 * corner)
            guess = left if to_left <= to_up and to_left <= to_corner else up if to_up <= to_corner else corner
        x[i] = (x[i] + guess) & 255
    return x


def field(message: bytes) -> list:
    """Identity, packing and values of one message, in the order of NAMES from discipline to values."""
    s = sections(message)
    product, packing = s[4], s[5]
    kind = int.from_bytes(product[7:9], "big")
    lead = signed(product[18:22]) * UNIT_HOURS.get(product[17], 0)
    if kind in INTERVAL:
        ranges = 34 if kind == 8 else 37
        lead += signed(product[ranges + 15 : ranges + 19]) * UNIT_HOURS.get(product[ranges + 14], 0)
    member = product[35] if kind in ENSEMBLE else 0
    level = signed(product[24:28]) * 10.0 ** -signed(product[23:24]) if product[22] != 255 else None
    nx, ny = struct.unpack(">II", s[3][30:38])
    count, template = struct.unpack(">IH", packing[5:11])
    reference, e, d, bits = struct.unpack(">f", packing[11:15])[0], signed(packing[15:17]), signed(packing[17:19]), packing[19]
    x = None
    if template in (0, 41) and bits == 0:
        x = np.zeros(count)
    elif template == 0:
        x = unpack(s[7][5:], bits, count)
    elif template in (2, 3):
        x = complex_values(packing, s[7][5:], template == 3) if count else np.zeros(0)
    elif template == 41:
        x = png_values(s[7][5:])
    values = None
    if x is not None:
        x = (reference + x[:count] * 2.0**e) / 10.0**d
        if s[6][5] == 0:
            there = np.unpackbits(np.frombuffer(s[6][6:], dtype=np.uint8), count=nx * ny).astype(bool)
            full = np.full(nx * ny, np.nan)
            full[there] = x
            x = full
        values = pa.array(x.astype(np.float32), pa.float32(), mask=np.isnan(x))
    return [message[6], product[9], product[10], product[22], level, lead, member, nx, ny, float(reference), e, d, bits, template, values]


def whole(blob: bytes) -> bytes:
    """The content of a file, decompressed if it is gzip or bzip2."""
    return gzip.decompress(blob) if blob[:2] == b"\x1f\x8b" else bz2.decompress(blob) if blob[:3] == b"BZh" else blob


def _fields(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = {"file": pa.string(), "error": pa.string(), "level": pa.float64(), "reference": pa.float64(), "values": pa.list_(pa.float32())}
    schema = pa.schema([(n, kinds.get(n, pa.int64())) for n in NAMES])

    def row(values: list) -> pa.RecordBatch:
        place = NAMES.index("values")
        cells = values[place]
        listed = pa.array([None], kinds["values"]) if cells is None else pa.ListArray.from_arrays(pa.array([0, len(cells)], pa.int32()), cells)
        return pa.RecordBatch.from_arrays([listed if i == place else pa.array([v], t) for i, (v, t) in enumerate(zip(values, schema.types))], schema=schema)

    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            at, n, size = 0, 0, None
            try:
                blob = whole(content.as_py())
                while at < len(blob):
                    size = struct.unpack(">Q", blob[at + 8 : at + 16])[0] if len(blob) >= at + 16 else None
                    if size is None or blob[at : at + 4] != b"GRIB" or size < 20 or blob[at + size - 4 : at + size] != b"7777":
                        raise ValueError(f"no whole message at byte {at}")
                    yield row([path, n, at, size, *field(blob[at : at + size]), None])
                    at, n, size = at + size, n + 1, None
            except (ValueError, KeyError, IndexError, struct.error, zlib.error, OSError, EOFError) as e:
                yield row([path, n, at, size, *[None] * (len(NAMES) - 5), f"{type(e).__name__}: {e}"])


def read_fields(spark: SparkSession, path: str) -> DataFrame:
    """One row a message of the GRIB 2 files under `path`; where one can't be read, a row with `error`."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content").mapInArrow(_fields, FIELDS)


def with_variables(fields: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Fields with the `var` of (discipline, category, number, surface, level); a NULL surface or level of the catalogue fits any."""
    c = catalogue.select("var", *(F.col(n).alias(f"__{n}") for n in ("discipline", "category", "number", "surface", "level")))
    same = (F.col("discipline") == F.col("__discipline")) & (F.col("category") == F.col("__category")) & (F.col("number") == F.col("__number"))
    fits = [F.col(f"__{n}").isNull() | (F.col(n) == F.col(f"__{n}")) for n in ("surface", "level")]
    return fields.join(c, same & fits[0] & fits[1]).select("var", *fields.columns)


def cells(fields: DataFrame) -> DataFrame:
    """(file, message, var, y, x, value), a row for each grid point; rows from the first scanned point."""
    at = fields.select("file", "message", "var", "nx", F.posexplode("values").alias("i", "value"))
    return at.select("file", "message", "var", F.floor(F.col("i") / F.col("nx")).alias("y"), (F.col("i") % F.col("nx")).alias("x"), "value")


def scale_faults(fields: DataFrame, places: int) -> DataFrame:
    """Messages that aren't decimal integers: a binary scale, a reference that is no integer, or another decimal scale."""
    return fields.where((F.col("binary_scale") != 0) | (F.col("reference") != F.rint("reference")) | (F.col("decimal_scale") != places)).select("file", "message", "binary_scale", "decimal_scale", "reference")


def stacked(cells: DataFrame, levels: list[float], keys: list[str], level: str = "level", value: str = "value") -> DataFrame:
    """(keys, `value`s in the order of `levels`), a row for each key; an absent level is NULL, other levels are left out."""
    named = F.map_from_entries(F.collect_list(F.struct(F.col(level).cast("double"), F.col(value))))
    one = cells.where(F.col(level).isin([float(x) for x in levels])).groupBy(*keys, level).agg(F.first(value).alias(value))
    return one.groupBy(*keys).agg(named.alias("__by")).select(*keys, F.transform(F.array(*(F.lit(float(x)) for x in levels)), lambda x: F.try_element_at("__by", x)).alias("values"))
