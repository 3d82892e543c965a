"""Importance resampling towards a target distribution by hashed n-grams.

Every run of words is hashed to a bucket by CRC-32. A bucket's gain is the logarithm of
its share in the target over its share in the corpus; a document's weight is its mean
gain, and documents are drawn without replacement by weight plus Gumbel noise that a
hash of the doc_id gives, so that a draw is the same whenever it is run.

Null texts have no words and no features; their weight is 0. Repeated rows are documents
of their own and rank one after the other. Rows of null doc_id have no noise: their score
is null, and they are neither drawn nor counted. Columns of the input pass through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bytescan import crc32_of_grams, runs
from .common import Workspace
from .kernels import IS_WORD, slices, utf8
from .ranking import with_rank

BUCKETS = 10_000
GRAMS = (1, 1)
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10


def _features(column: pa.Array, grams: tuple[int, int], buckets: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(lo, hi, words of each row, row and bucket of each feature) of slices of about a megabyte."""
    data, starts, ends = utf8(column)
    for lo, hi in slices(starts, ends):
        r = runs(data, starts[lo:hi], ends[lo:hi], IS_WORD)
        row, crc = crc32_of_grams(r, *grams)
        yield lo, hi, np.diff(r.first), row, (crc % np.uint32(buckets)).astype(np.int64)


def bucket_counts(texts: DataFrame, grams: tuple[int, int] = GRAMS, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall in each bucket: each task adds up, then at most `buckets` sums are collected."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for *_, bucket in _features(batch.column(0), grams, buckets):
                total += np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    sums = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, dtype=np.int64)
    for bucket, n in sums.collect():
        out[bucket] = n
    return out


def gains(target: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    """floor(1000 * ln(share in the target / share in the corpus)), both with one more feature a bucket."""
    b, t_all, s_all = len(target), float(target.sum()), float(corpus.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + b) / ((s + 1.0) * (t_all + b)))) for t, s in zip(target.tolist(), corpus.tolist())], dtype=np.int64)


def weights(docs: DataFrame, gain: np.ndarray, grams: tuple[int, int] = GRAMS) -> DataFrame:
    """`docs` with __n_words, __n_features and __weight, the floored mean gain."""
    fields = [T.StructField(n, T.LongType()) for n in ("__n_words", "__n_features", "__weight")]
    names = [*docs.columns, *(f.name for f in fields)]
    place = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # a number a bucket

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            n_words, n, total = (np.zeros(batch.num_rows, dtype=np.int64) for _ in range(3))
            column = batch.column(place)
            for lo, hi, words, row, bucket in _features(column, grams, len(table)):
                n_words[lo:hi] = words
                n[lo:hi] = np.bincount(row, minlength=hi - lo)
                total[lo:hi] = np.rint(np.bincount(row, weights=table[bucket].astype(float), minlength=hi - lo)).astype(np.int64)
            mean = np.where(n > 0, total // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n_words), pa.array(n), pa.array(mean)], names=names)

    return docs.mapInArrow(weigh, T.StructType([*docs.schema.fields, *fields]))


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """floor(1000 * Gumbel noise) from a hash of seed and doc_id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(docs: DataFrame, target: DataFrame, space: Workspace, grams: tuple[int, int] = GRAMS, buckets: int = BUCKETS, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """`docs` (doc_id, text) as (doc_id, n_features, weight, score, rank): the `percent` of best score among texts of `least_words` have a rank."""
    docs = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    gain = gains(bucket_counts(target, grams, buckets), bucket_counts(docs, grams, buckets))
    weighed = weights(docs, gain, grams).select("doc_id", F.col("__n_words").alias("n_words"), F.col("__n_features").alias("n_features"), F.col("__weight").alias("weight"), (F.col("__weight") + noise(F.col("doc_id"))).alias("score"))
    weighed = space.cut(weighed)
    entitled = (F.col("n_words") >= least_words) & F.col("doc_id").isNotNull()
    drawn = percent * weighed.where(entitled).count() // 100
    ranked = with_rank(weighed.where(entitled), [F.desc("score"), F.asc("doc_id"), F.asc("n_features")], space, "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = weighed.where(~entitled).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")


ORACLE_SQL = r"""
with tab as (select list_transform(range(256), lambda i: list_reduce([i::ubigint] || list_transform(range(8), lambda z: 0::ubigint), lambda x, z: xor(x >> 1, (x & 1::ubigint) * 3988292384::ubigint))) t),
words as (select 0 src, doc_id, lower_words w from (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') lower_words from documents)
  union all select 1, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') from benchmark),
keyed as materialized (select row_number() over () k, * from words),
f as materialized (select k, src, unnest(w) x from keyed),
hexed as (select distinct x, hex(encode(x)) h from f),
crc as materialized (select x, (xor(list_reduce([4294967295::ubigint] || list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::ubigint), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255::ubigint)::bigint + 1])), 4294967295::ubigint) % 10000)::bigint bucket from hexed, tab),
n as (select bucket, count(*) filter (src = 0) s, count(*) filter (src = 1) t from f join crc using (x) group by 1),
z as (select coalesce(sum(s), 0)::double s_all, coalesce(sum(t), 0)::double t_all from n),
g as (select bucket, floor(1000 * ln((t + 1.0::double) * (s_all + 10000) / ((s + 1.0::double) * (t_all + 10000))))::bigint gain from n, z),
m as (select k, sum(gain)::bigint total, count(*) n from f join crc using (x) join g using (bucket) where src = 0 group by 1),
d as (select doc_id, len(w) n_words, coalesce(n, 0)::bigint n_features, case when n is null then 0 else floor(total::decimal(38, 0) / n)::bigint end weight, ('0x' || substr(sha256('2024:' || doc_id::varchar), 1, 8))::bigint h from keyed left join m using (k) where src = 0),
e as (select doc_id, n_words, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296)))::bigint score from d),
r as (select *, row_number() over (order by score desc, doc_id, n_features) i, floor(10 * count(*) over () / 100) most from e where n_words >= 20 and doc_id is not null)
select doc_id, n_features, weight, score, case when i <= most then i end::bigint as rank from r
union all select doc_id, n_features, weight, score, null from e where n_words < 20 or doc_id is null
"""
