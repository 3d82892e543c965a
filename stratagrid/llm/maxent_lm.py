"""A hashed maximum-entropy language model, learned from a corpus and scored over it.

Tokens are runs of non-blank bytes, ASCII letters in lower case, and one end a text. The
counts of all training tokens make a table of the corpus's own size. From it comes the
base score (unigrams with one added), and the model's symbols: the most frequent tokens,
the end, and OTHER for the rest. A rest token's probability is OTHER's times its share
of the rest, with one added and one place for all unseen tokens, so that the model is a
distribution over the same tokens as the base.

A symbol's probability is a class's times the symbol's within the class, each a softmax
over `WIDTH` sums of weights: a bias, and features of the tokens before it (the last
one, the last two, and the one before the last alone) whose weights stand in a row of a
hashed table. The biases start at the counts' logarithms. Training goes once over all
training texts in `ROUNDS` parts, told by a hash of doc_id: each part's tasks sum what
was observed and what the model expects for every weight, the sums are added up block by
block, and every weight moves by its gradient (observed less expected) over its own mass
(half of observed and expected, and `DAMPING`).

Tokens that hold at least a 65536th of all training tokens (so at most 65536 of them)
go to every task; the others, of which none is frequent, meet the counts by a join. A
token of over `LONG_TOKEN` bytes is known by its SHA-256.

Null texts are empty and have the end only. Rows of null doc_id are held out. Repeated
rows are texts of their own. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytescan import Runs, runs
from .common import Workspace
from .kernels import LOWER, U64, cuts, run_codes, slices, utf8

IS_TOKEN = np.ones(256, dtype=bool)
IS_TOKEN[[0x20, *range(0x09, 0x0E)]] = False
END, LONG_TOKEN = "", 64
#: Tokens of at least one in so many go to every task.
SHARE = 65_536
#: Classes, and symbols of a class, at most.
WIDTH = 32
#: Rows of hashed weights, besides one of biases for each softmax.
ROWS = 1 << 15
BIASES = 1 + WIDTH
OTHER, LAST, START = 0, 1, WIDTH * WIDTH
ABSENT = -80.0
ROUNDS, RATE, DAMPING = 6, 0.5, 4.0
#: Bytes of text, and events, worked on at a time.
SLICE, EVENTS = 4 << 20, 1 << 17


def held_out(doc_id: str) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 7 == 2, F.lit(True))


def _pieces(text: np.ndarray, begin: np.ndarray, size: np.ndarray) -> pa.Array:
    """The tokens at these places as strings; a long one as a blank and its digest."""
    longs = np.flatnonzero(size > LONG_TOKEN)
    kept = size.copy()
    kept[longs] = 0
    to = np.cumsum(kept)
    flat = np.repeat(begin - (to - kept), kept) + np.arange(to[-1] if len(to) else 0)
    data = text[flat] if len(flat) else np.zeros(0, np.uint8)
    out = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(np.r_[0, to].astype(np.int64).tobytes()), pa.py_buffer(data.tobytes()))
    if len(longs):
        some = out.to_pylist()
        for i in longs.tolist():
            some[i] = " " + hashlib.sha256(text[begin[i] : begin[i] + size[i]].tobytes()).hexdigest()
        out = pa.array(some, pa.large_string())
    return out.cast(pa.string())


def piece_of(token: str) -> str:
    raw = token.encode()
    return " " + hashlib.sha256(raw).hexdigest() if len(raw) > LONG_TOKEN else token


def code_of(token: str) -> int:
    raw = LOWER[np.frombuffer(token.encode(), dtype=np.uint8)]
    return int(run_codes(raw, np.zeros(1, np.int64), np.array([len(raw)]))[0])


def token_counts(texts: DataFrame) -> DataFrame:
    """(token, c) over all texts; repeats are added up in each task's slices first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_texts = 0
        for batch in batches:
            n_texts += batch.num_rows
            data, starts, ends = utf8(batch.column(0))
            for lo, hi in slices(starts, ends, SLICE):
                r = runs(data, starts[lo:hi], ends[lo:hi], IS_TOKEN)
                if len(r.begin):
                    _, at, n = np.unique(run_codes(r.text, r.begin, r.size), return_index=True, return_counts=True)
                    yield pa.RecordBatch.from_arrays([_pieces(r.text, r.begin[at], r.size[at]), pa.array(n)], names=["token", "n"])
        if n_texts:
            yield pa.RecordBatch.from_arrays([pa.array([END]), pa.array([n_texts])], names=["token", "n"])

    found = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "token string, n long")
    return found.groupBy("token").agg(F.sum("n").alias("c"))


@dataclass(frozen=True)
class Lexicon:
    """What tasks need of the counts: totals, the frequent tokens by code, and which of them are symbols."""

    n: int
    v: int
    codes: np.ndarray  # of frequent tokens, ascending
    counts: np.ndarray
    symbols: np.ndarray  # of frequent tokens; OTHER if none
    of_symbol: np.ndarray  # the count of each symbol, OTHER's and the end's too
    words: tuple[str, ...]  # of symbols 2 and up
    end: int
    rest: float  # what a rest token's count is a share of, with ones added

    @property
    def smallest(self) -> float:
        """log10 of the base probability of an unseen token."""
        return -math.log10(self.n + self.v + 1)


def lexicon(counts: DataFrame) -> Lexicon:
    """counts: (token, c), written. At most `SHARE` rows and the end's are collected."""
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    frequent = {r.token: r.c for r in counts.where((F.col("c") * SHARE >= n) | (F.col("token") == END)).collect()}
    end = frequent.pop(END, 0)
    ranked = sorted(frequent.items(), key=lambda x: (-x[1], x[0].encode()))
    words = [t for t, _ in ranked if not t.startswith(" ")][: WIDTH * WIDTH - 2]
    symbol = {t: i + 2 for i, t in enumerate(words)}
    found = sorted((code_of(t), c, symbol.get(t, OTHER)) for t, c in ranked if not t.startswith(" "))  # long ones go by the join
    used = [frequent[t] for t in words]
    rest = n - end - sum(used)
    mass = np.array([rest + 1, end, *used], dtype=float)
    columns = zip(*found) if found else ((), (), ())
    codes, tally, symbols = (np.array(c, dtype=t) for c, t in zip(columns, (U64, np.int64, np.int64)))
    return Lexicon(n, v, codes, tally, symbols, mass, tuple(words), end, float(rest + (v - len(words) - (end > 0)) + 1))


ENCODED = "row_of long, doc_id long, held_out boolean, ids binary, n_tokens long, n_rest long, known long, logs double, rest_logs double, tokens array<string>, n array<int>"


def encode(docs: DataFrame, lex: Lexicon) -> DataFrame:
    """A row for each text: its symbols, sums over its frequent tokens, and its other tokens with their numbers."""
    shared = docs.sparkSession.sparkContext.broadcast(lex)  # at most SHARE numbers
    columns = [c.strip().split()[0] for c in ENCODED.split(",")]

    def of(r: Runs, lex: Lexicon) -> list[pa.Array]:
        rows = len(r.first) - 1
        code = run_codes(r.text, r.begin, r.size)
        place = np.minimum(np.searchsorted(lex.codes, code), max(len(lex.codes) - 1, 0))
        hot = lex.codes[place] == code if len(lex.codes) else np.zeros(len(code), bool)
        hot &= r.size <= LONG_TOKEN
        symbol = np.where(hot, lex.symbols[place] if len(lex.codes) else OTHER, OTHER)
        log = np.where(hot, np.log10(lex.counts[place] + 1.0) if len(lex.codes) else 0.0, 0.0)
        per = lambda w: np.bincount(r.row, weights=w, minlength=rows)
        n_words = np.diff(r.first)
        ends = math.log10(lex.end + 1.0)
        # ids: each row's symbols, then the end
        ids = np.full(len(code) + rows, LAST, dtype=np.uint16)
        ids[np.arange(len(code)) + r.row] = symbol
        stops = 2 * (r.first[1:] + np.arange(1, rows + 1))
        ids = pa.LargeBinaryArray.from_buffers(pa.large_binary(), rows, [None, pa.py_buffer(np.r_[0, stops].astype(np.int64).tobytes()), pa.py_buffer(ids.tobytes())]).cast(pa.binary())
        cold = np.flatnonzero(~hot)
        order = cold[np.lexsort((code[cold], r.row[cold]))]
        new = np.flatnonzero(np.r_[True, (r.row[order][1:] != r.row[order][:-1]) | (code[order][1:] != code[order][:-1])][: len(order)])
        lead, n = order[new], np.diff(np.r_[new, len(order)])
        lists = np.searchsorted(r.row[lead], np.arange(rows + 1)).astype(np.int32)
        tokens = pa.ListArray.from_arrays(pa.array(lists), _pieces(r.text, r.begin[lead], r.size[lead]))
        numbers = pa.ListArray.from_arrays(pa.array(lists), pa.array(n.astype(np.int32)))
        known = per(hot.astype(float)).astype(np.int64) + (lex.end > 0)
        return [ids, pa.array(n_words + 1), pa.array(per((symbol == OTHER).astype(float)).astype(np.int64)), pa.array(known), pa.array(per(log) + ends), pa.array(per(np.where(symbol == OTHER, log, 0.0))), tokens, numbers]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts, ends = utf8(batch.column(3))
            for lo, hi in slices(starts, ends, SLICE):
                found = of(runs(data, starts[lo:hi], ends[lo:hi], IS_TOKEN), shared.value)
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(lo, hi - lo) for i in range(3)), *found], names=columns)

    rows = docs.select(F.monotonically_increasing_id().alias("row_of"), F.col("doc_id").cast("long").alias("doc_id"), held_out("doc_id").alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, ENCODED)


def first_weights(lex: Lexicon) -> np.ndarray:
    """Biases that give each class, and each symbol in its class, its share of the counts; features have no weight yet."""
    mass = np.zeros(WIDTH * WIDTH)
    mass[: len(lex.of_symbol)] = lex.of_symbol + 0.5
    mass = mass.reshape(WIDTH, WIDTH)
    rows = np.vstack([mass.sum(axis=1), mass])
    total = rows.sum(axis=1, keepdims=True)
    w = np.zeros((BIASES + ROWS, WIDTH), dtype=np.float32)
    w[:BIASES] = np.where(rows > 0, np.log(np.maximum(rows, 1e-300) / np.maximum(total, 1e-300)), ABSENT)
    return w


def feature_rows(one: np.ndarray, two: np.ndarray, node: np.ndarray) -> list[np.ndarray]:
    """The rows of weights of each event at a softmax (0: classes; 1 + class): bias, last token, last two, the one before the last."""
    a, b, n = one.astype(U64), two.astype(U64), node.astype(U64)
    out = [node.astype(np.uint16)]
    for kind, (x, y) in enumerate(((a, U64(0)), (a, b + U64(1)), (U64(0), b + U64(1)))):
        h = (x * U64(0x9E3779B97F4A7C15) ^ (y * U64(0xC2B2AE3D27D4EB4F))) + n * U64(0x165667B19E3779F9) + U64(kind + 1) * U64(0x27D4EB2F165667C5)
        h = (h ^ (h >> U64(29))) * U64(0xBF58476D1CE4E5B9)
        out.append((BIASES + (h >> U64(64 - 15)).astype(np.int64)).astype(np.uint16))
    return out


def softmax_of(w: np.ndarray, rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(logits less their maximum, their exponentials)."""
    z = w[rows[0]]
    for r in rows[1:]:
        z += w[r]
    z -= z.max(axis=1, keepdims=True)
    return z, np.exp(z)


def events(ids: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(two before, one before, symbol) as one number for each token of each text, and where texts begin."""
    sizes = np.array([len(x) // 2 for x in ids], dtype=np.int64)
    y = np.frombuffer(b"".join(ids), dtype=np.uint16).astype(np.int64)
    first = np.cumsum(sizes) - sizes
    one, two = np.full(len(y), START), np.full(len(y), START)
    one[1:], two[2:] = y[:-1], y[:-2]
    one[first] = two[first] = START
    second = first[sizes > 1] + 1
    two[second] = START
    return (two << 22) | (one << 11) | y, first, sizes


def unpack(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return key >> 22, (key >> 11) & 2047, key & 2047


def _add(total: np.ndarray, rows: np.ndarray, p: np.ndarray) -> None:
    """total[rows] += p, equal rows added up by a sort."""
    order = np.argsort(rows, kind="stable")
    r = rows[order]
    new = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
    total[r[new]] += np.add.reduceat(p[order], new, axis=0)


def add_gradient(w: np.ndarray, key: np.ndarray, n: np.ndarray, observed: np.ndarray, expected: np.ndarray) -> None:
    """What `n` times the events `key` show of each weight, and what the model expects."""
    two, one, y = unpack(key)
    for node, target in ((np.zeros_like(y), y // WIDTH), (1 + y // WIDTH, y % WIDTH)):
        rows = feature_rows(one, two, node)
        _, e = softmax_of(w, rows)
        e *= (n / e.sum(axis=1))[:, None].astype(np.float32)
        for r in rows:
            _add(expected, r, e)
            np.add.at(observed.reshape(-1), r.astype(np.int64) * WIDTH + target, n)


def log_probabilities(w: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Natural logarithm of each event's probability."""
    two, one, y = unpack(key)
    out = np.zeros(len(key))
    for node, target in ((np.zeros_like(y), y // WIDTH), (1 + y // WIDTH, y % WIDTH)):
        z, e = softmax_of(w, feature_rows(one, two, node))
        out += z[np.arange(len(y)), target] - np.log(e.sum(axis=1))
    return out


def moved(w: np.ndarray, observed: np.ndarray, expected: np.ndarray) -> np.ndarray:
    """The weights after one update."""
    return (w + RATE * (observed - expected) / ((observed + expected) / 2 + DAMPING)).astype(np.float32)


def _chunks(column: pa.Array) -> Iterator[list[bytes]]:
    texts = column.to_pylist()
    for lo, hi in cuts(np.array([len(x) // 2 for x in texts]), EVENTS):
        yield texts[lo:hi]


#: Numbers of a block of sums; a task adds up one block at a time.
BLOCK = 1 << 16


def gradient(encoded: DataFrame, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(observed, expected) of all texts of `encoded`: two numbers a weight from each task, added up by blocks; their sums are collected, whose size is the model's."""
    spark = encoded.sparkSession
    shared = spark.sparkContext.broadcast(w)  # of fixed size

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        observed, expected = np.zeros(w_shape), np.zeros(w_shape)
        some = False
        for batch in batches:
            for ids in _chunks(batch.column(0)):
                key, n = np.unique(events(ids)[0], return_counts=True)
                add_gradient(shared.value, key, n.astype(float), observed, expected)
                some = True
        if some:
            both = np.concatenate([observed.ravel(), expected.ravel()]).astype(np.float32)
            for i in range(0, len(both), BLOCK):
                if both[i : i + BLOCK].any():
                    yield pa.RecordBatch.from_arrays([pa.array([i // BLOCK]), pa.array([both[i : i + BLOCK].tobytes()])], names=["block", "part"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, part in zip(*(c.to_pylist() for c in batch.columns)):
                x = np.frombuffer(part, dtype=np.float32)
                total[block] = total[block] + x if block in total else x.astype(float)
        for block, x in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([x.tobytes()])], names=["block", "part"])

    w_shape = w.shape
    tasks = max(1, spark.sparkContext.defaultParallelism)  # a model's sums leave each task
    parts = encoded.select("ids").coalesce(tasks).mapInArrow(sums, "block long, part binary")
    both = np.zeros(2 * w.size)
    for block, part in parts.repartition("block").mapInArrow(added, "block long, part binary").toLocalIterator():
        both[block * BLOCK : block * BLOCK + len(part) // 8] = np.frombuffer(part, dtype=float)
    shared.destroy()
    return both[: w.size].reshape(w.shape), both[w.size :].reshape(w.shape)


def train(encoded: DataFrame, lex: Lexicon, rounds: int = ROUNDS) -> np.ndarray:
    """Weights after one pass over the texts that aren't held out, in `rounds` parts."""
    w = first_weights(lex)
    learned = encoded.where("not held_out").withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(rounds)))
    for k in range(rounds):
        w = moved(w, *gradient(learned.where(F.col("part") == k), w))
    return w


def score(encoded: DataFrame, counts: DataFrame, lex: Lexicon, w: np.ndarray) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of `encoded`."""
    shared = encoded.sparkSession.sparkContext.broadcast(w)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for ids in _chunks(batch.column(1)):
                key, first, _ = events(ids)
                distinct, place = np.unique(key, return_inverse=True)
                logs = np.concatenate([log_probabilities(shared.value, distinct[i : i + EVENTS]) for i in range(0, len(distinct), EVENTS)])
                found.append(np.add.reduceat(logs[place], first))
            if found:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(found) / math.log(10))], names=["row_of", "symbols"])

    modelled = encoded.select("row_of", "ids").mapInArrow(run, "row_of long, symbols double")
    rare = encoded.select("row_of", F.explode(F.arrays_zip("tokens", "n")).alias("x")).select("row_of", F.col("x.tokens").alias("token"), F.col("x.n").alias("n"))
    met = rare.join(counts, "token").groupBy("row_of").agg(F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("rare_logs"), F.sum("n").alias("rare_known"))
    found = encoded.drop("ids", "tokens", "n").join(modelled, "row_of").join(met, "row_of", "left")
    logs = F.coalesce("rare_logs", F.lit(0.0))
    rest = F.col("rest_logs") + logs - F.col("n_rest") * F.lit(math.log10(lex.rest))
    return found.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"), F.lit(lex.n).cast("long").alias("train_tokens"),
        (F.col("logs") + logs + F.col("n_tokens") * F.lit(lex.smallest)).alias("base_score"), (F.col("symbols") + rest).alias("score"),
    )


def language_model_scores(docs: DataFrame, space: Workspace) -> DataFrame:
    """Learn from the texts of `docs` (doc_id, text) that aren't held out, and score all."""
    counts = space.cut(token_counts(docs.where(~held_out("doc_id"))))
    lex = lexicon(counts)
    encoded = space.cut(encode(docs, lex))
    return score(encoded, counts, lex, train(encoded, lex))
