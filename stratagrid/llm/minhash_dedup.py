"""Near-duplicate texts by ProbMinHash, banding and verification.

A document is a weighted set of shingles (five words; the weight is the number of
occurrences). Its similarity to another is the probability Jaccard index

    J(x, y) = sum over shared i of 1 / (sum over j of max(x_j / x_i, y_j / y_i)),

which is the common Jaccard index where no shingle repeats. Every shingle is a
Poisson process whose rate is its weight: its arrivals fall on random registers, a
register keeps the shingle that reached it first, and a shingle stops once it is
later than the latest register. Registers of two documents agree with probability J.

Plan: one pass over the texts writes a slim table of signatures; equal word
sequences are pre-aggregated to one representative; representatives that share a
band are compared with the one of the smallest doc_id and verified on whole texts; bands
that still hold several components have these compared across, by their registers
first and then by text; components are contracted by joins. Texts are shuffled once,
for candidates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import Workspace
from .components import components

SHINGLE = 5
THRESHOLD = 0.8
#: A pair with J = 0.8 shares a band with probability 1 - (1 - 0.8 ** 6) ** 28 = 0.9998.
BANDS, ROWS = 28, 6
#: Of these the first BANDS * ROWS make bands; all serve to exclude pairs before their texts are read.
REGISTERS = 336
BLOCK, COPIES, RUN = 512, 32, 1 << 19


def signatures(row: np.ndarray, code: np.ndarray, weight: np.ndarray, n_rows: int, registers: int) -> np.ndarray:
    """ProbMinHash of weighted sets: (n_rows, registers) codes; 0 where a row has no element."""
    best = np.full(n_rows * registers, np.inf)
    kept = np.zeros(n_rows * registers, dtype=K.U64)
    live, clock, drawn, width = np.arange(len(code)), np.zeros(len(code)), 0, 1
    while len(live):
        n = K.mix(code[live][:, None] + (np.arange(drawn + 1, drawn + width + 1, dtype=K.U64) * K.GOLDEN)[None, :])
        gap = -np.log(((n >> K.U64(11)).astype(float) + 0.5) * 2.0**-53) / weight[live][:, None]
        when = clock[live][:, None] + np.cumsum(gap, axis=1)
        register = ((K.mix(n ^ K.U64(0xD6E8FEB86659FD93)) >> K.U64(32)) * K.U64(registers) >> K.U64(32)).astype(np.int64)
        slot = (row[live][:, None] * registers + register).ravel()
        at = when.ravel()
        early = np.flatnonzero(at < best[slot])
        slot, at, who = slot[early], at[early], live[early // width]
        np.minimum.at(best, slot, at)
        won = best[slot] == at
        kept[slot[won]] = code[who[won]]
        clock[live] = when[:, -1]
        latest = best.reshape(n_rows, registers).max(axis=1)
        live = live[clock[live] < latest[row[live]]]
        drawn += width
        width = min(64, max(width, 100_000 // max(1, len(live))), 2 * width)
    return kept.reshape(n_rows, registers)


def band_keys(kept: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(n, bands): one code for the registers of each band."""
    key = np.zeros((len(kept), bands), dtype=K.U64) + np.arange(bands, dtype=K.U64) * K.GOLDEN
    cut = kept[:, : bands * rows].reshape(len(kept), bands, rows)
    for i in range(rows):
        key = K.mix(key * K.U64(K.BASE) + cut[:, :, i])
    return key


def _sketch(shingle: int, bands: int, rows: int, registers: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts, ends = K.utf8(batch.column(2))
            for lo, hi in K.slices(starts, ends):
                w = K.words(data, starts[lo:hi], ends[lo:hi])
                n = np.diff(w.first)
                row, code = K.shingles(w, shingle)
                kept = signatures(*K.counted(row, code), hi - lo, registers)
                key = band_keys(kept, bands, rows)
                place = (np.arange(len(w.code)) - w.first[w.row]).astype(K.U64)
                digest = []
                for salt in (1, 2):  # an order-sensitive sum of 128 bits over the words
                    sums = np.zeros(len(w.code) + 1, dtype=K.U64)
                    np.cumsum(K.mix(w.code + place * K.GOLDEN + K.U64(salt)), out=sums[1:])
                    digest.append(K.as_long(K.mix(sums[w.first[1:]] - sums[w.first[:-1]])))
                offsets = np.arange(hi - lo + 1, dtype=np.int32) * bands
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(lo, hi - lo) for i in (0, 1)), pa.array(n), *digest, pa.ListArray.from_arrays(offsets, K.as_long(key.ravel())), pa.array([x.tobytes() for x in kept.astype(np.uint8)], pa.binary())],
                    ["doc_id", "text_id", "n_words", "d1", "d2", "bands", "low"],
                )

    return run


def similarity(row: np.ndarray, a: tuple, b: tuple, n: int) -> np.ndarray:
    """J of n pairs, from the counted (row, code, weight) of their two sides."""
    row = np.r_[a[0], b[0]]
    code = np.r_[a[1], b[1]]
    order = np.lexsort((code, row))
    row, code = row[order], code[order]
    x = np.r_[a[2], np.zeros(len(b[2]))][order]
    y = np.r_[np.zeros(len(a[2])), b[2]][order]
    new = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (code[1:] != code[:-1])]) if len(row) else np.zeros(0, np.int64)
    row = row[new]
    x, y = (np.add.reduceat(v, new) if len(new) else v for v in (x, y))
    with np.errstate(divide="ignore"):
        ratio = np.where(y > 0, x / np.where(y > 0, y, 1), np.inf)
    order = np.lexsort((ratio, row))
    row, x, y, ratio = row[order], x[order], y[order], ratio[order]
    first = np.searchsorted(row, np.arange(n + 1))
    cx, cy = np.r_[0, np.cumsum(x)], np.r_[0, np.cumsum(y)]
    both = np.flatnonzero((x > 0) & (y > 0))
    # of each shared shingle: all up to and with its ratio count by y, the others by x
    same = np.flatnonzero(np.r_[(row[1:] != row[:-1]) | (ratio[1:] != ratio[:-1]), True]) if len(row) else both
    last = same[np.searchsorted(same, both)] + 1
    lo, hi = first[row[both]], first[row[both] + 1]
    total = ratio[both] * (cy[last] - cy[lo]) + (cx[hi] - cx[last])
    return np.bincount(row[both], x[both] / total, minlength=n)


def _verify(shingle: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [K.utf8(batch.column(i)) for i in (2, 3)]
            size = sum(np.maximum(e - s, 0) for _, s, e in sides)
            ends = np.cumsum(size)
            for lo, hi in K.slices(ends - size, ends):
                counted = [K.counted(*K.shingles(K.words(d, s[lo:hi], e[lo:hi]), shingle)) for d, s, e in sides]
                good = np.flatnonzero(similarity(None, *counted, hi - lo) >= threshold - 1e-12)
                part = batch.slice(lo, hi - lo).select(["a", "b"])
                yield part.take(pa.array(good))

    return run


def likely_matches(threshold: float, registers: int) -> int:
    """Equal registers that a pair at the threshold has but for 1 case in 2,000 (3.3 standard deviations)."""
    return int(threshold * registers - 3.3 * np.sqrt(threshold * (1 - threshold) * registers))


def _across(least: int, below: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = [np.zeros((0, 2), np.int64)]
        pdf = pdf.sort_values(["run", "lo", "hi"])
        key = pdf[["run", "lo", "hi"]].to_numpy()
        edges = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1), True])
        low = np.frombuffer(b"".join(pdf.low), dtype=np.uint8).reshape(len(pdf), -1)
        keys = np.array(pdf.bands.tolist(), dtype=np.int64)
        rep, comp, block, band = (pdf[c].to_numpy() for c in ("node", "component", "block", "band"))
        for s, e in zip(edges[:-1], edges[1:]):
            one_block = key[s, 1] == key[s, 2]
            for i in range(s, e):
                other = np.arange(i + 1, e)
                other = other[(comp[other] != comp[i]) & (one_block | (block[other] != block[i]))]
                shared = keys[other] == keys[i]  # a pair belongs to the first of the bands that it shares
                other = other[keys[i][shared.argmax(axis=1)] == band[i]]
                equal = (low[other] == low[i]).sum(axis=1)
                fit = (equal >= least) & (equal < below)
                other, equal = other[fit], equal[fit]
                out.append(np.column_stack([np.minimum(rep[other], rep[i]), np.maximum(rep[other], rep[i])]))
        return pd.DataFrame(np.unique(np.concatenate(out), axis=0), columns=["a", "b"])

    return run


def _narrower(large: DataFrame, groups: DataFrame, threshold: float, run: int, registers: int) -> DataFrame:
    """Members (band, run, node, component) of large bands (band, n, node, component), banded again by further registers."""
    r = F.ceil(F.log(F.col("n") / run) / F.log(F.lit(1 / 0.6))).cast("int")
    ways = F.ceil(F.log(F.lit(0.0005)) / F.log(1 - F.pow(F.lit(threshold), F.col("r")))).cast("int")
    rows = large.withColumn("r", r).withColumn("way", F.explode(F.sequence(F.lit(1), ways))).join(groups.select("node", "low"), "node")
    picked = F.transform(F.sequence(F.lit(1), F.col("r")), lambda i: F.substring("low", F.pmod(F.xxhash64(F.col("way"), i), F.lit(registers)).cast("int") + 1, F.lit(1)))
    return rows.select("band", F.xxhash64("band", "way", picked).alias("run"), "node", "component")


def across_components(placed: DataFrame, groups: DataFrame, ws: Workspace, least: int, below: int, threshold: float, registers: int, block: int = BLOCK, run: int = RUN) -> DataFrame:
    """Pairs (a, b) of one band, of different components, with `least` to `below` - 1 equal registers.

    Members of a band are compared block by block on the low bytes of their registers
    inside tasks of bounded size; only pairs that the registers can't exclude leave them.
    """
    several = lambda df, by: df.groupBy(by).agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("n")).where("x < y").select(by, "n")
    mixed = ws.cut(several(placed, "band"))
    small = mixed.where(F.col("n") <= run).select("band", "n", F.col("band").alias("run"))
    rows = placed.join(small, "band").select("band", "run", "n", "node", "component")
    if not mixed.where(F.col("n") > run).isEmpty():
        narrow = ws.cut(_narrower(placed.join(mixed.where(F.col("n") > run), "band"), groups, threshold, run, registers))
        rows = rows.union(narrow.join(several(narrow, "run"), "run").select("band", "run", "n", "node", "component"))
    size = F.greatest(F.lit(block), F.ceil(F.col("n") / COPIES))
    rows = rows.withColumn("blocks", F.ceil(F.col("n") / size).cast("long")).withColumn("block", F.pmod(F.xxhash64("node"), "blocks"))
    rows = rows.join(groups.select("node", "low", "bands"), "node")
    rows = rows.withColumn("partner", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = ws.cut(rows.select("band", "run", "node", "component", "low", "bands", "block", F.least("block", "partner").alias("lo"), F.greatest("block", "partner").alias("hi")))
    tasks = max(1, rows.count() // 4000)
    pairs = rows.groupBy(F.pmod(F.xxhash64("run", "lo", "hi"), F.lit(tasks)).alias("task")).applyInPandas(_across(least, below), "a long, b long")
    return pairs.distinct()


def near_duplicates(docs: DataFrame, ws: Workspace, threshold: float = THRESHOLD, shingle: int = SHINGLE, bands: int = BANDS, rows: int = ROWS, registers: int = REGISTERS) -> DataFrame:
    """(doc_id, text_id, class_id, n_words, kept), a row for each row of `docs` (doc_id: long, text: string; others are ignored).

    class_id is the smallest doc_id that links of similarity >= `threshold` reach from
    the row's text; kept marks it. Texts of fewer than `shingle` words are one shingle.
    Null texts, empty ones and those without words stay alone. Equal doc_ids with
    different texts are documents of their own, told apart by text_id, a hash of the
    text. A null doc_id links with nothing: class_id is null and kept true.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).select("doc_id", F.xxhash64("text").alias("text_id"), "text")
    sketched = ws.cut(texts.mapInArrow(_sketch(shingle, bands, rows, registers), "doc_id long, text_id long, n_words long, d1 long, d2 long, bands array<long>, low binary"))
    real = sketched.where("n_words > 0 and doc_id is not null")
    groups = real.groupBy("d1", "d2").agg(F.min(F.struct("doc_id", "text_id")).alias("rep"), F.min("bands").alias("bands"), F.min("low").alias("low"))
    groups = ws.cut(groups.select("d1", "d2", "rep.*", "bands", "low", F.monotonically_increasing_id().alias("node")))
    banded = groups.select("node", "doc_id", F.explode("bands").alias("band"))
    centre = banded.groupBy("band").agg(F.min(F.struct("doc_id", "node")).alias("top"), F.count("*").alias("n")).where("n > 1")
    centre = ws.cut(centre.select("band", F.col("top.node").alias("centre")))
    member = ws.cut(banded.select("band", "node").join(centre, "band"))
    apart = member.where("node <> centre")
    pairs = ws.cut(apart.select(F.least("centre", "node").alias("a"), F.greatest("centre", "node").alias("b")).distinct())
    wanted = groups.join(member.select("node").distinct(), "node").select("node", "doc_id", "text_id")
    some = ws.cut(texts.join(wanted, ["doc_id", "text_id"]).dropDuplicates(["node"]).select("node", "text"))

    def verified(p: DataFrame) -> DataFrame:
        a, b = (some.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}")) for c in "ab")
        return ws.cut(p.join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b").mapInArrow(_verify(shingle, threshold), "a long, b long"))

    links = verified(pairs)
    found = ws.cut(components(links, ws).withColumnRenamed("node", "name"))
    # bands that still hold several components: compare across these, the likeliest pairs first
    least = likely_matches(threshold, registers)
    steps = [registers + 1, max(least, int((threshold - 0.03) * registers)), least]
    for below, from_ in zip(steps, steps[1:]):
        placed = member.join(found, member["node"] == found["name"], "left").select("band", "node", F.coalesce("component", "node").alias("component"))
        across = across_components(ws.cut(placed), groups, ws, from_, below, threshold, registers)
        more = verified(ws.cut(across.join(pairs, ["a", "b"], "left_anti")))
        if not more.isEmpty():
            links = links.union(more)
            found = ws.cut(components(links, ws).withColumnRenamed("node", "name"))
    named = ws.cut(groups.join(found, groups["node"] == found["name"], "left").select("d1", "d2", "doc_id", F.coalesce("component", "node").alias("component")))
    least_id = named.groupBy("component").agg(F.min("doc_id").alias("found"))
    ids = ws.cut(named.join(least_id, "component").select("d1", "d2", "found"))
    member_of = sketched.select("doc_id", "text_id", "n_words", F.when(F.col("n_words") > 0, F.col("d1")).alias("d1"), "d2")
    out = member_of.join(ids, ["d1", "d2"], "left")
    class_id = F.when(F.col("doc_id").isNotNull(), F.coalesce("found", "doc_id"))
    return out.select("doc_id", "text_id", class_id.alias("class_id"), "n_words", F.coalesce(class_id == F.col("doc_id"), F.lit(True)).alias("kept"))
