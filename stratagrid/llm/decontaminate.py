"""Benchmark decontamination over a document-partitioned positional inverted index.

Index: every task turns its documents into postings (term -> token positions) of all
their words and stores one row of postings per megabyte of text, with the
documents' boundaries. Terms are 64-bit codes of words. The index is written once.
Search: a test item's window of consecutive words is looked up from its rarest term,
by frequency over the whole corpus; the lists of its other terms, moved by their
offsets in the window, are intersected one after another from rare to common, and what
is left are exact occurrences. Proximity matches need the rarest distinct terms of a
window near a posting of the rarest one, in any order, inside one document.

Neither documents nor postings are shuffled. The test items are the stated query set:
they are taken in blocks of bounded size, each sent to all index rows; with several
blocks, hit intervals are merged by the number that the index gives each document row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import Workspace

WINDOW = 13
#: Bytes of test items in one block; their terms and windows take about ten times that in a task.
BLOCK_BYTES = 4_000_000
#: Bytes of text in one row of the index.
INDEX_BYTES = 1 << 20
#: Proximity: so many of a window's rarest terms within so many words.
NEAR_TERMS, NEAR_WORDS = 3, 24

INDEX = "row array<long>, doc_id array<long>, n_words array<int>, terms binary, counts binary, positions binary"


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """terms: codes in ascending order (64 bits); counts (32 bits) of their postings, which stand in positions (32 bits), ascending for each term."""
    for batch in batches:
        data, starts, ends = K.utf8(batch.column(2))
        for lo, hi in K.slices(starts, ends, INDEX_BYTES):
            w = K.words(data, starts[lo:hi], ends[lo:hi])
            order = np.argsort(w.code, kind="stable")
            code = w.code[order]
            first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]]) if len(code) else order
            lists = [pa.array([batch.column(i).slice(lo, hi - lo).to_pylist()], pa.list_(pa.int64())) for i in (0, 1)]
            arrays = (code[first], np.diff(np.r_[first, len(code)]).astype(np.uint32), order.astype(np.uint32))
            yield pa.RecordBatch.from_arrays([*lists, pa.array([np.diff(w.first)], pa.list_(pa.int32())), *(pa.array([x.tobytes()], pa.binary()) for x in arrays)], ["row", "doc_id", "n_words", "terms", "counts", "positions"])


class Items:
    """One block of test items as arrays: vocabulary, terms by item, windows and their terms from rare to common."""

    def __init__(self, ids: list, texts: list, window: int):
        data, starts, ends = K.utf8(pa.array(texts, pa.large_string()))
        w = K.words(data, starts, ends)
        names = {x: i for i, x in enumerate(dict.fromkeys(ids))}  # rows of one item_id are one item
        self.ids, self.window = list(names), window
        self.vocabulary, self.term = np.unique(w.code, return_inverse=True)
        count = np.diff(w.first)
        length = np.minimum(count[w.row], window)
        place = np.arange(len(w.code)) - w.first[w.row]
        self.start = np.flatnonzero(place + length <= count[w.row]) if len(w.code) else np.zeros(0, np.int64)
        self.start = self.start[(count[w.row[self.start]] >= window) | (place[self.start] == 0)]
        self.length, self.item = length[self.start], np.array([names[x] for x in ids], np.int64)[w.row[self.start]]

    def rank(self, frequency: np.ndarray, near_terms: int) -> None:
        """Order every window's offsets by the frequency of their terms, then by the place where the term first stands."""
        width, n = self.window, len(self.start)
        offset = np.minimum(np.arange(width)[None, :], self.length[:, None] - 1)
        terms = self.term[self.start[:, None] + offset] if n else np.zeros((0, width), np.int64)
        debut = (terms[:, :, None] == terms[:, None, :]).argmax(axis=2) if n else terms
        order = np.lexsort((offset, debut, frequency[terms] if n else terms), axis=1)
        self.offsets, self.terms = (np.take_along_axis(x, order, axis=1) for x in (offset, terms))
        distinct = np.cumsum(np.diff(self.terms, axis=1, prepend=-1) != 0, axis=1)
        self.near = np.full((n, near_terms), -1)
        for k in range(near_terms):
            has = (distinct > k).any(axis=1)
            self.near[has, k] = self.terms[has, (distinct[has] > k).argmax(axis=1)]


class Postings:
    """The postings of one index row for the terms of a vocabulary; a key is term * (words + 1) + position, ascending."""

    def __init__(self, row: dict, vocabulary: np.ndarray):
        n_words = np.array(row["n_words"], dtype=np.int64)
        self.first = np.r_[0, np.cumsum(n_words)]
        self.n = int(self.first[-1])
        self.doc_of = np.repeat(np.arange(len(n_words)), n_words)
        code, counts = np.frombuffer(row["terms"], K.U64), np.frombuffer(row["counts"], np.uint32).astype(np.int64)
        at = np.minimum(np.searchsorted(code, vocabulary), max(0, len(code) - 1))
        has = code[at] == vocabulary if len(code) else np.zeros(len(vocabulary), bool)
        self.count = np.where(has, counts[at], 0) if len(code) else has.astype(np.int64)
        self.start = np.cumsum(self.count) - self.count
        term = np.repeat(np.arange(len(vocabulary)), self.count)
        begins = np.where(has, (np.cumsum(counts) - counts)[at], 0) if len(code) else self.count
        self.position = np.frombuffer(row["positions"], np.uint32)[np.arange(len(term)) - np.repeat(self.start - begins, self.count)].astype(np.int64)
        self.key = term * (self.n + 1) + self.position

    def holds(self, term: np.ndarray, position: np.ndarray) -> np.ndarray:
        key = term * (self.n + 1) + position
        at = np.searchsorted(self.key, key)
        return (at < len(self.key)) & (self.key[np.minimum(at, len(self.key) - 1)] == key)

    def holds_between(self, term: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        key = term * (self.n + 1)
        return np.searchsorted(self.key, key + low) < np.searchsorted(self.key, key + high, side="right")


def _matches(items: Items, p: Postings, near_words: int, limit: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(window, position of its first word) of exact occurrences, and (window, position) of proximity matches."""
    lead = items.terms[:, 0]
    have = p.count[lead]
    for lo, hi in K.cuts(have, limit):  # one window alone may have more candidates, as many as its rarest term has postings
        which = np.repeat(np.arange(lo, hi), have[lo:hi])
        if not len(which):
            continue
        nth = np.arange(len(which)) - np.repeat(np.cumsum(have[lo:hi]) - have[lo:hi], have[lo:hi])
        found = p.position[p.start[lead[which]] + nth]
        doc = p.doc_of[found]
        begin, start, stop = found - items.offsets[which, 0], p.first[doc], p.first[doc + 1]
        good = np.flatnonzero((begin >= start) & (begin + items.length[which] <= stop))
        for i in range(1, items.terms.shape[1]):
            good = good[p.holds(items.terms[which[good], i], begin[good] + items.offsets[which[good], i])]
        near = np.arange(len(which))
        low, high = np.maximum(start, found - near_words), np.minimum(stop - 1, found + near_words)
        for i in range(1, items.near.shape[1]):
            term = items.near[which[near], i]
            near = near[(term < 0) | p.holds_between(term, low[near], high[near])]
        yield which[good], begin[good], which[near], found[near]


def _search(items: Items, near_words: int, every_row: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                p = Postings(row, items.vocabulary)
                n, doc_of, first = p.n, p.doc_of, p.first
                hit, item_of, near_of = np.zeros(n + 1, np.int64), [], []
                for window, begin, near, found in _matches(items, p, near_words):
                    np.add.at(hit, begin, 1)
                    np.add.at(hit, begin + items.length[window], -1)
                    item_of.append(np.unique(np.column_stack([doc_of[begin], items.item[window]]), axis=0))
                    near_of.append(np.unique(np.column_stack([doc_of[found], items.item[near]]), axis=0))
                inside = np.cumsum(hit)[:n] > 0
                edge = np.flatnonzero(inside & ~np.r_[False, inside[:-1]] | inside & np.r_[True, doc_of[1:] != doc_of[:-1]]) if n else np.zeros(0, np.int64)
                stop = np.flatnonzero(inside & ~np.r_[inside[1:], False] | inside & np.r_[doc_of[1:] != doc_of[:-1], True]) + 1 if n else edge
                spans, ids, close = ([[] for _ in row["n_words"]] for _ in range(3))
                for d, s, e in zip(doc_of[edge].tolist(), edge.tolist(), stop.tolist()):
                    spans[d].append({"start": s - int(first[d]), "end": e - int(first[d])})
                for store, pairs in ((ids, item_of), (close, near_of)):
                    for d, i in np.unique(np.concatenate(pairs), axis=0).tolist() if pairs else []:
                        store[d].append(items.ids[i])
                out = pa.RecordBatch.from_arrays(
                    [pa.array(row["row"], pa.int64()), pa.array(row["doc_id"], pa.int64()), pa.array(row["n_words"], pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), pa.array(ids, pa.list_(pa.string())), pa.array(close, pa.list_(pa.string()))],
                    ["row", "doc_id", "n_words", "spans", "items", "near_items"],
                )
                yield out if every_row else out.filter(pa.array([bool(i or c) for i, c in zip(ids, close)]))

    return run


def _frequencies(index: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """How often the corpus has each term of `vocabulary` (ascending codes), which is of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for terms, counts in zip(*batch.columns):
                code, counts = np.frombuffer(terms.as_py(), K.U64), counts.as_py()
                at = np.searchsorted(vocabulary, code)
                known = np.flatnonzero((at < len(vocabulary)) & (vocabulary[np.minimum(at, len(vocabulary) - 1)] == code)) if len(vocabulary) else at[:0]
                total[at[known]] += np.frombuffer(counts, np.uint32)[known]
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["term", "n"])

    found = index.select("terms", "counts").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    frequency = np.zeros(len(vocabulary), np.int64)
    frequency[found["term"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return frequency


MATCHES = "row long, doc_id long, n_words long, spans array<struct<start: int, end: int>>, items array<string>, near_items array<string>"


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, ws: Workspace, window: int = WINDOW, near_terms: int = NEAR_TERMS, near_words: int = NEAR_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, spans, items, near_items), a row for each row of `docs` (doc_id, text).

    spans: maximal runs of words (start, end exclusive) inside exact occurrences of
    windows of `benchmark` (item_id, text); items: the items these belong to;
    near_items: items with a proximity match: the `near_terms` rarest distinct terms of
    one of its windows (all, if it has fewer) stand within `near_words` words of a
    posting of the rarest one, in one document. Null texts have no words; null doc_ids
    and repeated rows stay. Rows of one item_id are one item.
    """
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null and item_id is not null")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_bytes))
    index = ws.cut(texts.mapInArrow(_index, INDEX))
    parts = []
    for k in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).orderBy("item_id", "text").collect()  # of bounded size
        found = Items([r.item_id for r in block], [r.text for r in block], window)
        found.rank(_frequencies(index, found.vocabulary), near_terms)
        parts.append(index.mapInArrow(_search(found, near_words, k == 0), MATCHES))
    if blocks == 1:
        return parts[0].drop("row")
    every = parts[0]
    for p in parts[1:]:
        every = every.union(p)
    flat = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    merged = every.groupBy("row").agg(*(F.first(c).alias(c) for c in ("doc_id", "n_words")), *(flat(c).alias(c) for c in ("spans", "items", "near_items")))
    joined = F.aggregate(
        "spans",
        F.lit(None).cast("array<struct<start: int, end: int>>"),
        lambda acc, s: F.when(acc.isNull(), F.array(s))
        .when(F.element_at(acc, -1)["end"] >= s["start"], F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end")))))
        .otherwise(F.concat(acc, F.array(s))),
    )
    return merged.drop("row").withColumn("spans", F.coalesce(joined, F.array().cast("array<struct<start: int, end: int>>")))


def contamination(matches: DataFrame) -> DataFrame:
    """The contract's columns, and near_items: a document is contaminated if 5 % of its words or more are hit."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
    ids = F.array_sort("items")
    out = matches.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"), F.concat_ws(",", F.array_sort("near_items")).alias("near_items"))
    return out.withColumn("contaminated", F.expr("n_hit > 0 and 20 * n_hit >= n_words"))
