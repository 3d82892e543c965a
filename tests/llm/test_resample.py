import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from stratagrid.llm import bytescan, kernels, resample
from stratagrid.llm.common import Workspace

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def grams(t, least, most):
    w = words(t)
    return [" ".join(w[i : i + n]) for n in range(least, most + 1) for i in range(len(w) - n + 1)]


ODD = ["", None, "a", "É日本 a-b", "x" * 300 + " y", " tail", "A B c", "y" * 257 + "É", "...", "a\x00b", None, "q " * 700, "e" * 100_000]


def test_runs_and_crc_of_grams():
    for texts in (ODD, ODD[::-1], [None, None], [], ["", ""]):
        for column in (pa.array(texts, pa.string()), pa.array(["zz", *texts, "zz"], pa.large_string()).slice(1, len(texts))):
            r = bytescan.runs(*kernels.utf8(column), kernels.IS_WORD)
            got = [(int(k), r.text[b : b + n].tobytes().decode()) for k, b, n in zip(r.row, r.begin, r.size)]
            assert got == [(k, w) for k, t in enumerate(texts) for w in words(t)]
            for least, most in ((1, 1), (1, 3), (2, 2)):
                row, crc = bytescan.crc32_of_grams(r, least, most)
                assert Counter(zip(row.tolist(), crc.tolist())) == Counter((k, zlib.crc32(g.encode())) for k, t in enumerate(texts) for g in grams(t, least, most))


def plain(docs, items, least_words, percent, grams_of=(1, 1), buckets=10_000):
    s, t = Counter(), Counter()
    hashed = [[zlib.crc32(g.encode()) % buckets for g in grams(x, *grams_of)] for _, x in docs]
    for h in hashed:
        s.update(h)
    for x in items:
        t.update(zlib.crc32(g.encode()) % buckets for g in grams(x, *grams_of))
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * (sum(s.values()) + buckets) / ((s[b] + 1.0) * (sum(t.values()) + buckets))))
    rows = []
    for (d, x), h in zip(docs, hashed):
        weight = sum(map(gain, h)) // len(h) if h else 0
        score = None
        if d is not None:
            u = int(hashlib.sha256(f"2024:{d}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((u + 0.5) / 4294967296)))
        rows.append([d, len(h), weight, score, None, len(words(x))])
    able = sorted((r for r in rows if r[5] >= least_words and r[0] is not None), key=lambda r: (-r[3], r[0], r[1]))
    for i, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = i + 1
    return Counter(tuple(r[:5]) for r in rows)


def test_resample_is_the_plain_draw(spark):
    rng = np.random.default_rng(3)
    pool = np.array(["the", "of", "É", "日本", "Alpha", *(f"w{i}" for i in range(60))])
    docs = [(d, " ".join(rng.choice(pool, rng.integers(0, 60)))) for d in range(200)]
    docs += [(300 + i, t) for i, t in enumerate(ODD)] + [(None, "the " * 40), (None, None)] + [(400, "of the " * 30)] * 3 + [(400, "w1 " * 30)]
    items = [" ".join(rng.choice(pool[:20], 30)) for _ in range(10)] + [None, ""]
    frame = spark.createDataFrame([(d, t, 1, 2) for d, t in docs], "doc_id long, text string, rank int, __weight int").repartition(7)
    target = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string")
    for percent, grams_of in ((10, (1, 1)), (37, (1, 2))):
        got = resample.resample(frame, target, Workspace(spark, "t"), grams_of, percent=percent)
        assert Counter(map(tuple, got.collect())) == plain(docs, items, 20, percent, grams_of)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert resample.resample(none, none, Workspace(spark, "t")).collect() == []
    one = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert [tuple(r)[0:2] for r in resample.resample(one, none, Workspace(spark, "t")).collect()] == [(1, 3)]


def test_drawn_documents_are_nearer_to_the_target(spark):
    docs = [(d, ("target word here " if d % 10 == 0 else "quite another thing ") * 10) for d in range(500)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    target = spark.createDataFrame([(0, "target word here " * 50)], "item_id long, text string")
    drawn = resample.resample(frame, target, Workspace(spark, "t")).where("rank is not null").collect()
    assert len(drawn) == 50 and sum(r.doc_id % 10 == 0 for r in drawn) > 40
