"""A byte automaton on Arrow string columns: runs of a byte class, and CRC-32 of many runs at once."""

from __future__ import annotations

import zlib
from typing import NamedTuple

import numpy as np

from .kernels import LOWER

#: Runs beyond this many bytes take their CRC one by one.
LONG = 256


def crc_table() -> np.ndarray:
    """The 256 steps of the reflected CRC-32, from its polynomial."""
    x = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        x = np.where(x & 1, (x >> 1) ^ np.uint32(0xEDB88320), x >> 1).astype(np.uint32)
    return x


STEP = crc_table()
START = np.uint32(0xFFFFFFFF)


class Runs(NamedTuple):
    """Runs in order of rows; `text` has ASCII letters in lower case, `row` counts from 0."""

    text: np.ndarray
    begin: np.ndarray
    size: np.ndarray
    row: np.ndarray
    first: np.ndarray  # of each row, the index of its first run; one more entry at the end


def runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, inside: np.ndarray) -> Runs:
    """Maximal runs of bytes whose class in the table `inside` is true; a row's end ends a run.

    A lookup classifies all bytes, and differences of neighbouring classes are borders.
    """
    rows, size = len(starts), ends - starts
    if rows and (starts[1:] != ends[:-1]).any():  # bytes between rows belong to nulls
        data = np.concatenate([data[a:b] for a, b in zip(starts.tolist(), ends.tolist())]) if size.any() else data[:0]
        at = np.concatenate([[0], np.cumsum(size)])
    elif rows:
        data = data[starts[0] : ends[-1]]
        at = np.concatenate([starts, ends[-1:]]) - starts[0]
    if not rows or not len(data):
        none = np.zeros(0, np.int64)
        return Runs(np.zeros(0, np.uint8), none, none, none, np.zeros(rows + 1, np.int64))
    text = LOWER[data]
    member = inside[text]
    cut = np.zeros(len(text) + 1, dtype=bool)
    cut[at[:-1]] = cut[-1] = True
    begin = np.flatnonzero(member & np.r_[True, ~member[:-1] | cut[1:-1]])
    closed = np.flatnonzero(member & np.r_[~member[1:] | cut[1:-1], True])
    row = np.searchsorted(at, begin, side="right") - 1
    return Runs(text, begin, closed + 1 - begin, row, np.searchsorted(row, np.arange(rows + 1)))


def advance(state: np.ndarray, r: Runs, which: np.ndarray) -> np.ndarray:
    """CRC states after the bytes of the runs `which`, all runs a byte further at a time."""
    size = r.size[which]
    order = np.argsort(-np.minimum(size, LONG + 1), kind="stable")
    now, begin, size = state[order], r.begin[which][order], size[order]
    single = int(np.count_nonzero(size > LONG))
    for i in range(single):
        b = int(begin[i])
        now[i] = ~np.uint32(zlib.crc32(r.text[b : b + int(size[i])].tobytes(), int(~now[i])))
    left = np.searchsorted(-size[single:], -np.arange(LONG + 1), side="left")  # runs of over i bytes
    for i in range(LONG):
        hi = single + int(left[i])
        if hi == single:
            break
        x = now[single:hi]
        now[single:hi] = STEP[(x ^ r.text[begin[single:hi] + i]) & 255] ^ (x >> 8)
    out = np.empty_like(state)
    out[order] = now
    return out


def crc32_of_grams(r: Runs, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, CRC-32) of every run of `least` to `most` consecutive runs of a row, joined by a space."""
    which = np.arange(len(r.begin))
    state = np.full(len(which), START, dtype=np.uint32)
    rows, found = [], []
    for n in range(1, most + 1):
        if n > 1:
            keep = np.flatnonzero(which + n - 1 < r.first[r.row[which] + 1])
            which, state = which[keep], state[keep]
            state = STEP[(state ^ np.uint32(0x20)) & 255] ^ (state >> 8)
        state = advance(state, r, which + n - 1)
        if n >= least:
            rows.append(r.row[which])
            found.append(~state)
    return np.concatenate(rows), np.concatenate(found)
