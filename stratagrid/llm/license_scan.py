"""License scans: MinHash bands over overlapping windows, then exact containment; DataFrame functions only.

A template is a set of five-word shingles. Templates fall into classes by length;
texts are cut into overlapping windows of a class's size, such that every occurrence
lies in a window that is not much longer than it. A window and a template that share
one of `BANDS` MinHash values are a candidate; the window is reported if it contains
`THRESHOLD` of the template's shingles or more.

Guarantees: in every class a window around a match has Jaccard similarity 0.4 or more
with its template, so bands of one row miss it with probability (1 - 0.4) ** 24 =
0.000005 at most, and never where window and template are equal. Windows are only cut
around anchor words, which every match must hold: anchors are chosen so that the
template's shingles without any anchor are fewer than a match needs.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .license_texts import TEMPLATES

SHINGLE, THRESHOLD, BANDS = 5, 0.8, 24


def length_class(n_words: int) -> tuple[int, int, int]:
    """(longest template, stride, window), in words, of the class of templates of `n_words`; classes go up by half."""
    longest = SHINGLE
    while longest < n_words:
        longest = max(longest + 1, longest * 3 // 2 - (longest < 11))
    stride = max(1, longest // 6)
    return longest, stride, longest + stride - 1


def words(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower())


def shingles(w: list[str]) -> set[str]:
    return {" ".join(w[i : i + SHINGLE]) for i in range(len(w) - SHINGLE + 1)}


def anchors(templates: dict[str, str], threshold: float = THRESHOLD) -> list[str]:
    """Words one of which every match holds; rarer-looking (longer) words first."""
    chosen: set[str] = set()
    open_ = {n: words(t) for n, t in templates.items()}
    need = {n: math.ceil(threshold * len(shingles(w)) - 1e-9) for n, w in open_.items()}
    bare = lambda w: sum(chosen.isdisjoint(s.split()) for s in shingles(w))
    while left := {n for n, w in open_.items() if bare(w) >= need[n]}:
        votes: dict[str, int] = {}
        for n in left:
            for x in set(open_[n]) - chosen:
                votes[x] = votes.get(x, 0) + 1
        chosen.add(max(votes, key=lambda x: (len(x) > 6, votes[x], len(x), x)))
    return sorted(chosen)


def _template_rows(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    rows = []
    for name, text in templates.items():
        w = words(text)
        if len(w) < SHINGLE:
            raise ValueError(f"{name}: a template has {SHINGLE} words or more, as it has no shingle otherwise")
        rows.append((name, length_class(len(w))[0], sorted(shingles(w))))
    made = spark.createDataFrame(rows, "license string, class int, texts array<string>")
    return made.select("license", "class", F.transform("texts", lambda s: F.xxhash64(s)).alias("t"))


def _bands(hashes: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.lit(BANDS)), lambda b: F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, b))))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once a row: as a lambda's variable it is not written out at each use."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def license_matches(docs: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, license, containment, first_word): the best match of each license in each document of `docs` (doc_id, text).

    first_word is the first word, counted from 0, of the earliest window that matches.
    Null, empty and short texts match nothing; texts and templates may be of any length.
    Rows of one doc_id, or of null doc_id, are scanned apart and reported as one
    document; of equal matches the earliest window counts.
    """
    spark = docs.sparkSession
    found = anchors(templates, threshold)
    known = _template_rows(spark, templates)  # as many rows as the caller's dictionary has
    used = sorted({length_class(len(words(t))) for t in templates.values()})
    lower = F.lower(F.col("text"))
    some = lower.contains(found[0])
    for a in found[1:]:
        some = some | lower.contains(a)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(some)
    rows = rows.select("doc_id", F.monotonically_increasing_id().alias("row"), F.regexp_extract_all(lower, F.lit("[a-z0-9]+"), F.lit(0)).alias("w")).where(F.size("w") >= SHINGLE)
    is_anchor = lambda x: x.isin(found)
    at = F.filter(F.transform("w", lambda x, i: F.when(is_anchor(x), i)), lambda i: i.isNotNull())
    rows = rows.select("doc_id", "row", "w", at.alias("at")).where(F.size("at") > 0)

    def around(longest: int, stride: int, size: int) -> Column:
        first = lambda p: F.greatest(F.lit(0), F.ceil((p - size + 1) / stride)).cast("int")
        starts = F.array_distinct(F.flatten(F.transform("at", lambda p: F.sequence(first(p), F.floor(p / stride).cast("int")))))
        return F.transform(starts, lambda s: F.struct(F.lit(longest).alias("class"), (s * stride).alias("start"), F.lit(size).alias("size")))

    cut = rows.select("doc_id", "row", "w", F.explode(F.concat(*(around(*c) for c in used))).alias("x"))
    cut = cut.select("doc_id", "row", "x.*", "w").where(F.size("w") - F.col("start") >= SHINGLE)

    def hashed(v: Column) -> Column:
        h = F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(v) - SHINGLE + 1), lambda i: F.xxhash64(F.array_join(F.slice(v, i, SHINGLE), " "))))
        return _let(h, lambda h: F.struct(h.alias("h"), _bands(h).alias("bands")))

    windows = cut.select("doc_id", "row", "class", "start", _let(F.slice("w", F.col("start") + 1, F.col("size")), hashed).alias("s"))
    keys = known.select("license", "class", "t", F.posexplode(_bands(F.col("t"))).alias("band", "value"))
    values = [r.value for r in keys.select("value").distinct().collect()]  # BANDS of each template
    banded = windows.where(F.exists("s.bands", lambda v: v.isin(values))).select("doc_id", "row", "class", "start", F.col("s.h").alias("h"), F.posexplode("s.bands").alias("band", "value"))
    hit = banded.join(F.broadcast(keys), ["class", "band", "value"]).dropDuplicates(["row", "class", "start", "license"])  # each candidate once
    share = F.size(F.array_intersect("h", "t")) / F.size("t")
    return hit.select("doc_id", "license", "start", share.alias("share")).where(F.col("share") >= threshold - 1e-9).groupBy("doc_id", "license").agg(F.round(F.max("share"), 6).alias("containment"), F.min("start").cast("long").alias("first_word"))
