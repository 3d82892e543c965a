"""Language identification: known words first, then shorter and shorter character n-grams.

A word that training has seen scores its log frequency in each language. An unseen
word scores the mean log frequency of its n-grams of the greatest length at which at
least half of them are known, from `LONGEST` down to single characters; if not even
those are known, it says nothing. A document's score is the posterior over all its words.

A word is a run of letters and the marks on them. Training counts words and n-grams in
Spark over a sample chosen by a hash of doc_id: about `PER_LANGUAGE` documents a
language, fewer if there are so many languages that this is over `SAMPLE` in all, but
`LEAST_PER_LANGUAGE` at least. Every language is learned. A token that the sample holds
at least `LEAST_COUNT` times is kept with its count in every language that has it. The
model is sparse (a row for each kept token and language that has it), so it grows with
the sample's distinct tokens and not with tokens times languages; `fit` raises an error
beyond `MODEL_ROWS` rows instead of leaving any out.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernels as K

PER_LANGUAGE, SAMPLE, LEAST_PER_LANGUAGE = 1500, 20_000, 50
LEAST_COUNT, MODEL_ROWS = 2, 30_000_000
LONGEST = 5
SMOOTH = 0.5
UNKNOWN = "und"
LETTER, MARK = 1, 2
#: Sparse scores that a task adds up at a time.
ENTRIES = 4_000_000


def held_out(doc_id: Column | str) -> Column:
    """Rows kept from training: crc32 of doc_id as text, mod 5, is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False)) if isinstance(doc_id, str) else F.crc32(doc_id.cast("string")) % 5 == 0


class Table(NamedTuple):
    """Tokens of one size: `gain` of each language that has the token over `base`, its log frequency where it has not."""

    code: np.ndarray  # ascending
    first: np.ndarray  # of each token, its first entry; one more at the end
    lang: np.ndarray
    gain: np.ndarray
    base: np.ndarray  # by language


class Model(NamedTuple):
    languages: list[str]
    tables: list[Table]  # words, then n-grams of 1 to LONGEST characters


class Runs(NamedTuple):
    """The words of texts: characters, where each word begins and how long it is, its text and its code."""

    chars: np.ndarray
    begin: np.ndarray
    size: np.ndarray
    row: np.ndarray
    code: np.ndarray
    lettered: np.ndarray  # of each text, whether it has a letter


def _kind(c: int) -> int:
    k = unicodedata.category(chr(c))[0]
    return LETTER if k == "L" else MARK if k == "M" else 0


_KINDS: list[np.ndarray] = []


def kinds(chars: np.ndarray) -> np.ndarray:
    """LETTER, MARK or 0 of every character."""
    if not _KINDS:
        _KINDS.append(np.array([_kind(c) for c in range(1 << 16)], dtype=np.uint8))
    found = _KINDS[0][np.minimum(chars, 0xFFFF)]
    far = np.flatnonzero(chars > 0xFFFF)
    if len(far):
        names, at = np.unique(chars[far], return_inverse=True)
        found[far] = np.array([_kind(c) for c in names.tolist()], dtype=np.uint8)[at]
    return found


def word_runs(texts: list[str]) -> Runs:
    lower = [t.lower() for t in texts]
    starts = np.r_[0, np.cumsum([len(t) + 1 for t in lower])]
    chars = np.frombuffer("\n".join(lower).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    kind = kinds(chars)
    edge = np.diff((kind > 0).astype(np.int8), prepend=0, append=0)
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    letters = np.r_[0, np.cumsum(kind == LETTER)]
    lettered = letters[np.maximum(starts[1:] - 1, starts[:-1])] > letters[starts[:-1]] if len(texts) else np.zeros(0, bool)
    return Runs(chars, begin, end - begin, np.searchsorted(starts, begin, side="right") - 1, K.run_codes(chars.view(np.uint8), 4 * begin, 4 * (end - begin)), lettered)


def gram_codes(chars: np.ndarray, begin: np.ndarray, size: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For n = 1 to LONGEST, (word, code) of the n-grams of words; but for n = 1, a word stands between `<` and `>`."""
    width = size + 2
    word = np.repeat(np.arange(len(size)), width)
    place = np.arange(len(word)) - np.repeat(np.cumsum(width) - width, width)
    inner = (place > 0) & (place <= size[word])
    text = np.where(place == 0, ord("<"), ord(">")).astype(K.U64)
    text[inner] = chars[begin[word[inner]] + place[inner] - 1]
    code, found = K.mix(text + K.GOLDEN), []
    for n in range(1, LONGEST + 1):
        if n > 1:
            code = K.mix(code[:-1] * K.U64(K.BASE) + text[n - 1 :]) if len(code) else code
        whole = np.flatnonzero(inner if n == 1 else place[: len(code)] + n <= width[word[: len(code)]])
        found.append((word[whole], code[whole]))
    return found


def _count(languages: list[str]):
    number = {x: i for i, x in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = (batch.column(i).to_pylist() for i in (0, 1))
            for lo, hi in K.cuts(np.array([len(t) for t in texts]), 1 << 20):
                w = word_runs(texts[lo:hi])
                lang = np.array([number[x] for x in langs[lo:hi]], np.int64)[w.row]
                lang, code, n = K.counted(lang, w.code)  # distinct words of each language
                at = np.argsort(w.code, kind="stable")[np.searchsorted(np.sort(w.code), code)]
                rows = [(0, lang, code, n)]
                for size, (word, gram) in enumerate(gram_codes(w.chars, w.begin[at], w.size[at]), 1):
                    order = np.lexsort((gram, lang[word]))
                    by, gram, often = lang[word][order], gram[order], n[word][order]
                    new = np.flatnonzero(np.r_[True, (by[1:] != by[:-1]) | (gram[1:] != gram[:-1])]) if len(gram) else np.zeros(0, np.int64)
                    rows.append((size, by[new], gram[new], np.add.reduceat(often, new) if len(new) else often))
                cols = [np.concatenate(c) for c in zip(*((np.full(len(r[1]), r[0]), *r[1:]) for r in rows))]
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), K.as_long(cols[2]), pa.array(cols[3].astype(np.int64))], ["size", "lang", "code", "n"])

    return run


def _table(rows: pa.Table, languages: int) -> Table:
    lang, n = rows["lang"].to_numpy().astype(np.int32), rows["n"].to_numpy().astype(float)
    code = rows["code"].to_numpy().view(K.U64)
    order = np.lexsort((lang, code))
    code, lang, n = code[order], lang[order], n[order]
    first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]]) if len(code) else np.zeros(0, np.int64)
    total = np.bincount(lang, n, minlength=languages) + SMOOTH * (len(first) + 1)
    return Table(code[first], np.r_[first, len(code)], lang, np.log(n / SMOOTH + 1), np.log(SMOOTH / total))


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, sample: int = SAMPLE, least_count: int = LEAST_COUNT) -> Model:
    """Learn from `docs` (doc_id, lang, text): rows with a lang and text that are not held out.

    Rows of null doc_id teach nothing; repeated rows count as often as they occur.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    sizes = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row a language
    languages = sorted(sizes)
    if not languages:
        return Model([], [])
    wanted = max(LEAST_PER_LANGUAGE, min(per_language, sample // len(languages)))
    shares = spark.createDataFrame([(x, min(1.0, wanted / sizes[x])) for x in languages], "lang string, share double")
    chosen = rows.join(F.broadcast(shares), "lang").where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.col("share") * (1 << 30)).select("lang", "text")
    counts = chosen.mapInArrow(_count(languages), "size int, lang int, code long, n long").groupBy("size", "code", "lang").agg(F.sum("n").alias("n"))
    tokens = counts.groupBy("size", "code").agg(F.sum("n").alias("total"), F.collect_list(F.struct("lang", "n")).alias("by")).where(F.col("total") >= least_count)  # a token has as many as there are languages
    kept = tokens.select("size", "code", F.explode("by").alias("x")).select("size", "code", "x.lang", "x.n")
    found = kept.limit(MODEL_ROWS + 1).toArrow()
    if len(found) > MODEL_ROWS:
        raise ValueError(f"over {MODEL_ROWS} rows in the model: lower per_language and sample, or raise least_count")
    size = found["size"].to_numpy()
    return Model(languages, [_table(found.filter(pa.array(size == n)), len(languages)) for n in range(LONGEST + 1)])


class Scorer:
    """Languages of texts, a slice of texts at a time."""

    def __init__(self, model: Model):
        self.model = model

    def _add(self, total: np.ndarray, table: Table, owner: np.ndarray, token: np.ndarray, weight: np.ndarray) -> None:
        """Add to the rows `owner` of `total` the weighted log frequencies of tokens of `table`."""
        n = len(self.model.languages)
        total += np.bincount(owner, weight, minlength=len(total))[:, None] * table.base
        many = table.first[token + 1] - table.first[token]
        ends = np.cumsum(many)
        for lo, hi in K.cuts(many, ENTRIES):
            reps = many[lo:hi]
            entry = np.repeat(table.first[token[lo:hi]] - (ends[lo:hi] - reps - (ends[lo] - reps[0])), reps) + np.arange(reps.sum())
            cell = np.repeat(owner[lo:hi], reps) * n + table.lang[entry]
            total += np.bincount(cell, np.repeat(weight[lo:hi], reps) * table.gain[entry], minlength=total.size).reshape(total.shape)

    @staticmethod
    def _known(table: Table, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(table.code, code), max(0, len(table.code) - 1))
        return at, table.code[at] == code if len(table.code) else np.zeros(len(code), bool)

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(log scores by text and language, whether the text has a letter)."""
        w = word_runs(texts)
        names, first, at = np.unique(w.code, return_index=True, return_inverse=True)
        pair, often = np.unique(w.row * len(names) + at, return_counts=True)
        row, word = np.divmod(pair, max(1, len(names)))
        total = np.zeros((len(texts), len(self.model.languages)))
        token, known = self._known(self.model.tables[0], names)
        seen = known[word]
        self._add(total, self.model.tables[0], row[seen], token[word[seen]], often[seen].astype(float))
        row, word, often = row[~seen], word[~seen], often[~seen]
        new = np.flatnonzero(~known)
        by_size = gram_codes(w.chars, w.begin[first[new]], w.size[first[new]])
        number = np.full(len(names), -1)
        number[new] = np.arange(len(new))
        word, open_ = number[word], np.ones(len(new), dtype=bool)
        for size in range(LONGEST, 0, -1):
            table, (of, gram) = self.model.tables[size], by_size[size - 1]
            use = open_[of]
            of, gram = of[use], gram[use]
            token, known = self._known(table, gram)
            hits, all_ = np.bincount(of[known], minlength=len(new)), np.bincount(of, minlength=len(new))
            solved = (hits > 0) & (2 * hits >= all_)
            use = np.flatnonzero(known & solved[of])
            of, token = of[use], token[use]
            mine = np.flatnonzero(solved[word])  # (text, word) pairs that this size scores
            reps, start = hits[word[mine]], np.searchsorted(of, word[mine])
            gram_at = np.repeat(start - (np.cumsum(reps) - reps), reps) + np.arange(reps.sum())
            self._add(total, table, np.repeat(row[mine], reps), token[gram_at], np.repeat(often[mine] / np.maximum(reps, 1), reps))
            open_ &= ~solved
        return total, w.lettered

    def __call__(self, texts: list[str | None]) -> list[tuple[str, float]]:
        if not self.model.languages:
            return [(UNKNOWN, 0.0)] * len(texts)
        out = []
        for lo, hi in K.cuts(np.array([len(t or "") for t in texts]), 1 << 20):
            total, lettered = self.scores([t or "" for t in texts[lo:hi]])
            best = total.argmax(axis=1)
            odds = np.exp(total - total.max(axis=1, keepdims=True))
            share = odds.max(axis=1) / odds.sum(axis=1)
            out += [(self.model.languages[b], s) if ok else (UNKNOWN, 0.0) for b, s, ok in zip(best.tolist(), share.tolist(), lettered.tolist())]
        return out


def _predict(model: Model, place: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            found = scorer(batch.column(place).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], [*batch.schema.names, "__lang_pred", "__lang_score"])

    return run


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` with __lang_pred and __lang_score (0 to 1) from its column text.

    `und` and 0 if the text is null or has no letter, or nothing was learned. Ties go
    to the language that sorts first. The text alone decides, however long it is; other
    columns pass through, but for columns of the two names, which are replaced.
    """
    docs = docs.drop("__lang_pred", "__lang_score")
    schema = T.StructType([*docs.schema.fields, T.StructField("__lang_pred", T.StringType()), T.StructField("__lang_score", T.DoubleType())])
    return docs.mapInArrow(_predict(model, docs.columns.index("text")), schema)
