"""Array kernels on Arrow string columns: words, shingles and hashes without a Python loop per word.

A word is a maximal run of ASCII digits, ASCII letters (lower-cased) and characters
beyond ASCII. Every byte of such a character is over 0x7F in UTF-8, so words are
found on bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

U64 = np.uint64
GOLDEN = U64(0x9E3779B97F4A7C15)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_WORD = np.zeros(256, dtype=bool)
IS_WORD[48:58] = IS_WORD[65:91] = IS_WORD[97:123] = IS_WORD[128:] = True
BASE = 0x5851F42D4C957F2D


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


#: Words of more bytes are hashed one by one.
LONG = 128
_MASK = np.array([0, *((1 << 8 * k) - 1 for k in range(1, 9))], dtype=U64)


def run_codes(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """64-bit codes of runs of bytes; equal runs have equal codes.

    Eight bytes a step go through a bijective mixer, so runs of up to eight bytes of
    one size never collide, and no relation of letters makes longer ones collide.
    """
    raw = np.zeros(len(data) + 8, dtype=np.uint8)
    raw[: len(data)] = data
    eight = np.ndarray(len(data) + 1, "<u8", raw, strides=(1,))
    code = mix((size.astype(U64) + U64(1)) * GOLDEN)
    left = np.flatnonzero((size > 0) & (size <= LONG))
    at = 0
    while len(left):
        rest = np.minimum(size[left] - at, 8)
        code[left] = mix((code[left] ^ (eight[begin[left] + at] & _MASK[rest])) * U64(BASE) + U64(at))
        at += 8
        left = left[size[left] > at]
    for i in np.flatnonzero(size > LONG).tolist():
        code[i] = int.from_bytes(hashlib.blake2b(raw[begin[i] : begin[i] + size[i]], digest_size=8).digest(), "little")
    return code


class Words(NamedTuple):
    """Words in order of rows and positions; `row` counts from 0 within the slice."""

    code: np.ndarray
    row: np.ndarray
    first: np.ndarray  # of each row, the index of its first word; one more entry at the end


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of a string column, and where each row starts and ends; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    starts, ends = offsets[:-1].copy(), offsets[1:].copy()
    if column.null_count:
        gone = np.asarray(column.is_null())
        ends[gone] = starts[gone]
    return data, starts, ends


def cuts(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges whose sizes sum to `limit` at most; a larger one stands alone."""
    total = np.cumsum(sizes)
    lo = 0
    while lo < len(sizes):
        base = total[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(total, base + limit, side="right")))
        yield lo, hi
        lo = hi


def slices(starts: np.ndarray, ends: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of rows of about `limit` bytes; a longer row stands alone."""
    return cuts(ends - starts, limit)


def words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Words:
    """The words of rows whose bytes lie in ascending order in `data`."""
    rows = len(starts)
    if not rows or ends.max() <= starts.min():
        return Words(np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(rows + 1, np.int64))
    origin = starts[0]
    text = LOWER[data[origin : ends[-1]]] if ends[-1] > origin else LOWER[data[origin : ends.max()]]
    n = len(text)
    inside = IS_WORD[text]
    full = ends > starts
    at, to = starts[full] - origin, ends[full] - origin
    gaps = np.flatnonzero(at[1:] > to[:-1])
    for g in gaps.tolist():  # bytes under a null
        inside[to[g] : at[g + 1]] = False
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0] = after[-1] = False
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[at] = False
    after[to - 1] = False
    begin, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    code = run_codes(text, begin, end - begin)
    owners = np.flatnonzero(full)
    row = owners[np.searchsorted(at, begin, side="right") - 1]
    return Words(code, row, np.searchsorted(row, np.arange(rows + 1)))


def shingles(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, code) of every run of `size` words; a shorter row that has words is one shingle."""
    count = np.diff(w.first)
    code = np.zeros(len(w.code), dtype=U64)
    length = np.minimum(count[w.row], size)
    place = np.arange(len(w.code)) - w.first[w.row]
    whole = place + length <= count[w.row]
    start = np.flatnonzero(whole)
    for i in range(size):
        reach = start[length[start] > i]
        code[reach] = mix(code[reach] * U64(BASE) + w.code[reach + i] + U64(i))
    return w.row[start], code[start]


def counted(row: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, code) in order of rows, and how often each occurs."""
    if not len(row):
        return row, code, np.zeros(0)
    order = np.lexsort((code, row))
    row, code = row[order], code[order]
    new = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (code[1:] != code[:-1])])
    return row[new], code[new], np.diff(np.r_[new, len(row)]).astype(float)


def as_long(x: np.ndarray) -> pa.Array:
    """Unsigned 64-bit codes as Spark's long."""
    return pa.array(np.ascontiguousarray(x).view(np.int64))
