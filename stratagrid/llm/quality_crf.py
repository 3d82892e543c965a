"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its features are ratios of character classes, word lengths
and repetition in the line itself and in the lines before and after it; neighbouring
labels are tied by transition weights. A document's quality is the mean of the lines'
forward-backward marginals, weighted by length, mapped by a logistic calibration.

Labels are of documents: a first logistic model spreads them over lines, lines of bad
documents that it finds clearly good become good, and the field is trained on the
result. It is fitted on labelled documents in the order of a hash of doc_id, as many as
`SAMPLE` and until they have `LINES` lines together (a bound for training alone; the
document that passes it is still taken whole). In training, ties reach over `CHAIN`
lines at most. Scoring reads every line of every text, as one chain.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernels as K
from .langid import held_out

SAMPLE, LINES, CHAIN = 3000, 200_000, 512
CUT = 0.3
UPPER, LETTER, DIGIT, SPACE, STOP, SYMBOL, OTHER = range(7)
NAMES = ("bias", "length", "upper", "mostly_upper", "digit", "space", "stop", "exclaim", "bar", "symbol", "symbols", "symbol_words", "word_length", "long_word", "distinct", "repetitive", "same_as_before", "run", "empty", "repeated_line")
WIDTH = 3 * len(NAMES)


def _classes() -> np.ndarray:
    kinds = np.full(1 << 16, OTHER, dtype=np.uint8)
    for c in range(1 << 16):
        k = unicodedata.category(chr(c))
        kinds[c] = UPPER if k in ("Lu", "Lt") else LETTER if k[0] in "LM" else DIGIT if k[0] == "N" else SPACE if k[0] == "Z" or chr(c).isspace() else OTHER
    for c in ".,;:?!'\"()-":
        kinds[ord(c)] = STOP
    for c in "#$%&*+/<=>@[\\]^_`{|}~":
        kinds[ord(c)] = SYMBOL
    return kinds


_KINDS: list[np.ndarray] = []


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, length, document) of every line of `texts`; a text has a line more than line ends."""
    if not _KINDS:
        _KINDS.append(_classes())
    counts = np.array([t.count("\n") + 1 for t in texts], dtype=np.int64)
    doc = np.repeat(np.arange(len(texts)), counts)
    chars = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    n = len(chars)
    breaks = np.flatnonzero(chars == 10)
    start, end = np.r_[0, breaks + 1], np.r_[breaks, n]
    length = (end - start).astype(float)
    kind = _KINDS[0][np.minimum(chars, 0xFFFF)]
    one = np.maximum(length, 1)

    def per_line(mask: np.ndarray) -> np.ndarray:
        total = np.zeros(n + 1, dtype=np.int32)
        np.cumsum(mask, out=total[1:])
        return (total[end] - total[start]).astype(float)

    upper, letter, symbol = per_line(kind == UPPER), per_line(kind == LETTER), per_line(kind == SYMBOL)
    inside = kind != SPACE
    before = np.r_[False, inside[:-1]]
    after = np.r_[inside[1:], False]
    first, last = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    line_of = np.searchsorted(start, first, side="right") - 1
    per_word = np.bincount(line_of, minlength=len(start)).astype(float)
    words = np.maximum(per_word, 1)
    code = K.run_codes(chars.view(np.uint8), 4 * first, 4 * (last - first))
    size = (last - first).astype(float)
    marks = np.zeros(n + 1, dtype=np.int32)
    np.cumsum(kind == SYMBOL, out=marks[1:])
    tally = lambda m: np.bincount(line_of, m, minlength=len(start))
    same = np.r_[False, (code[1:] == code[:-1]) & (line_of[1:] == line_of[:-1])][: len(code)]
    distinct = np.bincount(np.unique(np.column_stack([line_of.astype(K.U64), code]).view([("l", K.U64), ("c", K.U64)]).ravel())["l"].astype(np.int64), minlength=len(start)) if len(code) else np.zeros(len(start))
    line_code = K.run_codes(chars.view(np.uint8), 4 * start, 4 * (end - start))
    pair = K.mix(line_code + doc.astype(K.U64) * K.U64(K.BASE))
    _, back, often = np.unique(pair, return_inverse=True, return_counts=True)
    distinct_share = distinct / words
    up = upper / np.maximum(upper + letter, 1)
    own = np.column_stack([
        np.ones(len(start)), np.log1p(length) / 5, up, up > 0.6, per_line(kind == DIGIT) / one, per_line(kind == SPACE) / one, per_line(kind == STOP) / one, np.minimum(1, 10 * per_line(chars == 33) / one), np.minimum(1, 10 * per_line(chars == 124) / one),
        np.minimum(1, 5 * symbol / one), symbol / one > 0.05, tally(marks[last] > marks[first]) / words, np.minimum(2, tally(size) / words / 8), np.minimum(2, np.log1p(np.divide(tally(size**2), np.maximum(tally(size), 1))) / 3),
        distinct_share, (distinct_share < 0.5) & (per_word > 4), tally(same) / words, per_line(np.r_[False, (chars[1:] == chars[:-1]) & (chars[1:] != 32)][:n]) / one, length == 0, (often[back] > 1) & (length > 0),
    ]).astype(np.float32)
    edge = np.r_[True, doc[1:] != doc[:-1]]
    previous = np.vstack([np.zeros((1, own.shape[1]), np.float32), own[:-1]])
    previous[edge] = 0
    following = np.vstack([own[1:], np.zeros((1, own.shape[1]), np.float32)])
    following[np.r_[edge[1:], True]] = 0
    return np.hstack([own, previous, following]), np.maximum(length, 1), doc


class Field(NamedTuple):
    """Weights of a line being good, of equal neighbours, and of the calibration."""

    weights: np.ndarray
    tie: float
    slope: float
    shift: float


def _step(x: np.ndarray, tie: float) -> np.ndarray:
    return np.logaddexp(tie / 2 + x, -tie / 2) - np.logaddexp(-tie / 2 + x, tie / 2)


def _alive(size: np.ndarray) -> list[int]:
    """Of sizes in descending order, for each k how many are larger."""
    return [int(np.searchsorted(-size, -k, side="left")) for k in range(int(size[0]) + 1)]


def _entering(node: np.ndarray, first: np.ndarray, size: np.ndarray, turn: np.ndarray, way: int, tie: float) -> np.ndarray:
    """The message into each piece; turn counts a chain's pieces from 0 in the direction of travel, in which they follow each other."""
    carry = np.zeros(len(first))
    if not turn.any():
        return carry
    order = np.argsort(-size, kind="stable")
    alive = _alive(size[order])
    # a piece maps the odds r that enter it to (a r + b) / (c r + d), all four in logarithms
    a, b, c, d = np.zeros(len(first)), np.full(len(first), -np.inf), np.full(len(first), -np.inf), np.zeros(len(first))
    for k in range(int(size.max())):
        on = order[: alive[k]]
        x = node[first[on] + way * k]
        a[on], b[on], c[on], d[on] = np.logaddexp(tie / 2 + x + a[on], c[on] - tie / 2), np.logaddexp(tie / 2 + x + b[on], d[on] - tie / 2), np.logaddexp(x - tie / 2 + a[on], tie / 2 + c[on]), np.logaddexp(x - tie / 2 + b[on], tie / 2 + d[on])
    for k in range(1, int(turn.max()) + 1):
        on = np.flatnonzero(turn == k)
        before = on - 1
        carry[on] = np.logaddexp(a[before] + carry[before], b[before]) - np.logaddexp(c[before] + carry[before], d[before])
    return carry


def _messages(node: np.ndarray, first: np.ndarray, size: np.ndarray, way: int, tie: float) -> np.ndarray:
    """The message into every line of chains that go from `first` in direction `way` (1 or -1)."""
    most = max(256, int(np.sqrt(size.max())))
    count = -(-size // most)  # pieces of a chain
    chain = np.repeat(np.arange(len(first)), count)
    turn = np.arange(len(chain)) - np.repeat(np.cumsum(count) - count, count)
    first, size = first[chain] + way * turn * most, np.minimum(size[chain] - turn * most, most)
    carry = _entering(node, first, size, turn, way, tie)
    order = np.argsort(-size, kind="stable")
    first, size, carry = first[order], size[order], carry[order]
    alive, out = _alive(size), np.zeros(len(node))
    for k in range(int(size[0])):
        m = alive[k]
        at = first[:m] + way * k
        out[at] = carry[:m]
        carry[:m] = _step(carry[:m] + node[at], tie)
    return out


def marginals(node: np.ndarray, doc: np.ndarray, tie: float) -> np.ndarray:
    """P(good) of each line; `node` are log odds, `doc` ascending.

    All chains step at once; a long one is cut in pieces, each of which first says how
    it maps what enters it, so that n lines take about 3 sqrt(n) steps.
    """
    if not len(node):
        return node
    first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    size = np.diff(np.r_[first, len(doc)])
    total = _messages(node, first, size, 1, tie) + node + _messages(node, first + size - 1, size, -1, tie)
    return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def qualities(field: Field, texts: list[str]) -> np.ndarray:
    x, length, doc = line_features(texts)
    p = marginals(x @ field.weights, doc, field.tie)
    mean = np.bincount(doc, p * length, minlength=len(texts)) / np.bincount(doc, length, minlength=len(texts))
    return _calibrated(mean, field.slope, field.shift)


def _calibrated(mean: np.ndarray, slope: float, shift: float) -> np.ndarray:
    mean = np.clip(mean, 1e-4, 1 - 1e-4)
    return 1 / (1 + np.exp(-(slope * np.log(mean / (1 - mean)) + shift)))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float, rounds: int = 25) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(h, x.T @ (weight * (y - p)) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def train(x: np.ndarray, length: np.ndarray, doc: np.ndarray, label: np.ndarray, rounds: int = 120, ridge: float = 1.0) -> Field:
    """Fit on lines (features, length, document) and documents' labels (1 good, 0 bad)."""
    x, y = x.astype(float), label[doc].astype(float)
    share = length / np.bincount(doc, length, minlength=len(label))[doc]
    w = _logistic(x, y, share * 5, ridge)
    line = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
    worst = np.full(len(label), np.inf)
    np.minimum.at(worst, doc, line)
    y[(y == 0) & (line > 0.95) & (line > worst[doc])] = 1
    edge = np.r_[True, doc[1:] != doc[:-1]]
    begin = np.flatnonzero(edge)
    place = np.arange(len(doc)) - np.repeat(begin, np.diff(np.r_[begin, len(doc)]))
    edge |= place % CHAIN == 0
    chain = np.cumsum(edge)
    inner = np.flatnonzero(~edge)
    equal = np.zeros(len(y))
    equal[inner] = y[inner] == y[inner - 1]
    # gradient ascent with Adam on log p(y | x); the expected ties come from pairwise marginals by finite difference of log Z
    tie, m, v = 1.0, np.zeros(x.shape[1] + 1), np.zeros(x.shape[1] + 1)
    for t in range(1, rounds + 1):
        node = x @ w
        p = marginals(node, chain, tie)
        grad = np.r_[x.T @ (y - p) - ridge * w, equal[inner].sum() - expected_ties(node, chain, tie) - ridge * tie] / max(1, len(label))
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        step = 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, tie = w + step[:-1], float(np.clip(tie + step[-1], 0, 3))
    p = marginals(x @ w, doc, tie)
    mean = np.clip(np.bincount(doc, p * share, minlength=len(label)), 1e-4, 1 - 1e-4)
    slope, shift = _logistic(np.column_stack([np.log(mean / (1 - mean)), np.ones(len(label))]), label.astype(float), np.ones(len(label)), 0.1)
    return Field(w.astype(np.float32), tie, float(max(slope, 1e-3)), float(shift))


def expected_ties(node: np.ndarray, doc: np.ndarray, tie: float, h: float = 1e-3) -> float:
    """Expected number of equal neighbours: the derivative of log Z by the tie weight."""

    def log_z(tie: float) -> float:
        first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        size = np.diff(np.r_[first, len(doc)])
        order = np.argsort(-size, kind="stable")
        first, size = first[order], size[order]
        good, bad = np.zeros(len(first)), np.zeros(len(first))
        good, bad = node[first], bad.copy()
        for k in range(1, int(size[0]) if len(size) else 0):
            n = int(np.searchsorted(-size, -k, side="left"))
            g, b = good[:n].copy(), bad[:n].copy()
            good[:n] = np.logaddexp(g + tie, b) + node[first[:n] + k]
            bad[:n] = np.logaddexp(b + tie, g)
        return float(np.logaddexp(good, bad).sum())

    return (log_z(tie + h) - log_z(tie - h)) / (2 * h)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each document: its lines' lengths and features."""
    for batch in batches:
        for doc_id, key, label, text in zip(*(c.to_pylist() for c in batch.columns)):
            x, length, _ = line_features([text])
            yield pa.RecordBatch.from_arrays([pa.array([doc_id], pa.int64()), pa.array([key], pa.int64()), pa.array([label], pa.int32()), pa.array([length.tobytes()], pa.binary()), pa.array([x.tobytes()], pa.binary())], ["doc_id", "key", "label", "length", "x"])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, lines: int = LINES) -> Field:
    """Learn from `docs` (doc_id, text) and `labels` (doc_id, quality 0/1) that are not held out.

    Documents with contradicting labels count as bad. Different texts of one doc_id are
    chains of their own, equal ones count once. Null texts and doc_ids teach nothing.
    Without labels of both kinds every score is 0.5.
    """
    spark = docs.sparkSession
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    chosen = marked.groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null and doc_id is not null")
    rows = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", F.xxhash64("text").alias("key"), "quality", "text")  # `sample` rows
    n_lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    sizes = rows.select("doc_id", "key", n_lines.alias("n")).groupBy("doc_id", "key").agg(F.max("n").alias("n")).orderBy(F.xxhash64("doc_id"), "doc_id", "key").limit(sample).collect()
    before = np.cumsum([r.n for r in sizes]) - [r.n for r in sizes]
    taken = [(r.doc_id, r.key) for r, b in zip(sizes, before) if b < lines]
    if not taken:
        return Field(np.zeros(WIDTH, np.float32), 0.0, 1.0, 0.0)
    taken = F.broadcast(spark.createDataFrame(taken, "doc_id long, key long"))  # `sample` rows at most
    rows = rows.join(taken, ["doc_id", "key"]).select("doc_id", "key", "quality", "text")
    found = rows.mapInArrow(_features, "doc_id long, key long, label int, length binary, x binary").toPandas()  # about `lines` lines
    if found.label.nunique() < 2:
        return Field(np.zeros(WIDTH, np.float32), 0.0, 1.0, 0.0)
    found = found.drop_duplicates(["doc_id", "key"]).sort_values(["doc_id", "key"], kind="stable")
    length = [np.frombuffer(b, dtype=float) for b in found.length]
    doc = np.repeat(np.arange(len(found)), [len(v) for v in length])
    x = np.frombuffer(b"".join(found.x), dtype=np.float32).reshape(len(doc), WIDTH)
    return train(x, np.concatenate(length), doc, found.label.to_numpy())


def _score(field: Field, place: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x or "" for x in batch.column(place).to_pylist()]
            found = [qualities(field, texts[lo:hi]) for lo, hi in K.cuts(np.array([len(t) for t in texts]), 1 << 20)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(found) if found else np.zeros(0))], [*batch.schema.names, "__quality"])

    return run


def score(docs: DataFrame, field: Field) -> DataFrame:
    """`docs` with __quality (0 to 1, higher is better) from its column text; null and empty texts are one empty line.

    Every row gets a score, repeated ones the same; a text of any length is one chain.
    A column __quality of `docs` is replaced.
    """
    docs = docs.drop("__quality")
    schema = T.StructType([*docs.schema.fields, T.StructField("__quality", T.DoubleType())])
    return docs.mapInArrow(_score(field, docs.columns.index("text")), schema)
