import math
import re
from collections import Counter

import numpy as np
import pytest

from stratagrid.llm import embedding_dedup, kernels as K, minhash_dedup
from stratagrid.llm.common import Workspace
from stratagrid.llm.components import components

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def bag(text):
    w = WORD.findall(lower(text or ""))
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def probability_jaccard(x, y):
    total = 0.0
    for i in x.keys() & y.keys():
        total += 1 / sum(max(x[j] / x[i], y[j] / y[i]) for j in x.keys() | y.keys())
    return total


def union_find(ids, links):
    name = {i: i for i in ids}

    def root(i):
        while name[i] != i:
            i = name[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        name[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def test_words_match_the_pattern():
    import pyarrow as pa

    texts = ["Ab-c é1 日本 x_y", None, "", "  ", "UPPER lower", "tail"]
    data, s, e = K.utf8(pa.array(texts))
    w = K.words(data, s, e)
    assert np.diff(w.first).tolist() == [len(WORD.findall(lower(t or ""))) for t in texts]
    again = K.words(*K.utf8(pa.array(["upper", "lower"])))
    assert w.code[w.first[4] : w.first[5]].tolist() == again.code.tolist()
    part = pa.array(["skip", *texts]).slice(1)
    assert K.words(*K.utf8(part)).code.tolist() == w.code.tolist()


def variants(rng, n_words, n, edits):
    base = [f"w{rng.integers(0, 5000)}" for _ in range(n_words)]
    for _ in range(n):
        v = list(base)
        for at in rng.integers(0, n_words, edits):
            v[at] = f"x{rng.integers(0, 10**6)}"
        yield " ".join(v)


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(3)
    texts = [*variants(rng, 200, 40, 2), *variants(rng, 120, 25, 4), *variants(rng, 60, 15, 1), *(" ".join(f"r{rng.integers(0, 3000)}" for _ in range(80)) for _ in range(40))]
    texts += ["one two three", "One, two; three!", "one two four", None, "", "", "!!!", "!!!", "echo " * 30, "echo " * 60, texts[0], texts[0].upper(), "word " * 20000]
    return [(i, t, "x") for i, t in enumerate(texts)]


def test_against_brute_force(spark, corpus):
    df = spark.createDataFrame(corpus, "doc_id long, text string, band string")  # a clashing name
    got = {r.doc_id: r for r in minhash_dedup.near_duplicates(df, Workspace(spark, "t")).collect()}
    bags = {i: bag(t) for i, t, _ in corpus}
    ids = [i for i in bags if bags[i]]
    sims = {(a, b): probability_jaccard(bags[a], bags[b]) for a in ids for b in ids if a < b and len(bags[a].keys() & bags[b].keys()) > 0}
    want = union_find(list(bags), [p for p, s in sims.items() if s >= 0.8 - 1e-12])
    assert {i: r.class_id for i, r in got.items()} == want
    assert all(r.kept == (r.class_id == i) for i, r in got.items()) and len(got) == len(corpus)


def test_similarity_and_signatures_agree():
    import pyarrow as pa

    rng = np.random.default_rng(5)
    a = " ".join(f"w{rng.integers(0, 30)} a b c d" for _ in range(60))
    b = " ".join(a.split()[:250]) + " " + " ".join(f"z{i}" for i in range(50))
    counted = [K.counted(*K.shingles(K.words(*K.utf8(pa.array([t]))), 5)) for t in (a, b)]
    exact = probability_jaccard(bag(a), bag(b))
    assert minhash_dedup.similarity(None, *counted, 1)[0] == pytest.approx(exact, abs=1e-9)
    sig = [minhash_dedup.signatures(*c, 1, 4000)[0] for c in counted]
    assert (sig[0] == sig[1]).mean() == pytest.approx(exact, abs=0.04)


def test_dedup_edge_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert minhash_dedup.near_duplicates(empty, Workspace(spark, "t")).count() == 0
    odd = spark.createDataFrame([(None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"), (3, "a b c d e f")], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.class_id, r.kept) for r in minhash_dedup.near_duplicates(odd, Workspace(spark, "t")).collect())
    assert got == [(0, None, True), (3, 3, True), (7, 3, False), (7, 3, False)]


def test_texts_of_one_doc_id_stay_apart(spark):
    """Two texts under doc_id 7: copies of either are linked, in every run."""
    one, two, three = (" ".join(f"{c}{i}" for i in range(60)) for c in "abc")
    rows = [(7, one), (7, two), (9, two), (8, one.replace("a30", "x")), (3, three), (7, three)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted((r.doc_id, r.class_id, r.kept) for r in minhash_dedup.near_duplicates(df, Workspace(spark, "t")).collect())
    assert got == [(3, 3, True), (7, 3, False), (7, 7, True), (7, 7, True), (8, 7, False), (9, 7, False)]


def test_long_words_of_equal_sums_differ(spark):
    one = "".join("ab"[i.bit_count() % 2] for i in range(2048))
    two = one.translate({97: "b", 98: "a"})
    df = spark.createDataFrame([(1, one), (2, two), (3, one)], "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in minhash_dedup.near_duplicates(df, Workspace(spark, "t")).collect()} == {1: 1, 2: 2, 3: 1}


def test_a_hot_band_of_many_components(spark):
    """20,000 members of one band that don't link: the rows sent stay within 33 a member, and pairs inside are found."""
    rng = np.random.default_rng(12)
    n, registers = 20_000, minhash_dedup.REGISTERS
    base = rng.integers(0, 256, registers, dtype=np.uint8)
    low = np.where(rng.random((n, registers)) < 0.62, base, rng.integers(0, 256, (n, registers), dtype=np.uint8))
    low[1::1000] = low[::1000]  # twenty pairs
    change = rng.random((20, registers)) < 0.1
    low[1::1000] = np.where(change, rng.integers(0, 256, (20, registers), dtype=np.uint8), low[1::1000])
    groups = spark.createDataFrame([(i, bytearray(x.tobytes()), [1]) for i, x in enumerate(low)], "node long, low binary, bands array<long>")
    placed = spark.range(n).selectExpr("1L as band", "id as node", "id as component")
    least = minhash_dedup.likely_matches(0.8, registers)
    want = {(i, i + 1) for i in range(0, n, 1000)}
    sent = []

    class Counting(Workspace):
        def cut(self, df):
            out = super().cut(df)
            sent.append(out.count())
            return out

    for run in (minhash_dedup.RUN, 4000):  # in one piece, and banded again
        sent.clear()
        ws = Counting(spark, "t")
        found = {(r.a, r.b) for r in minhash_dedup.across_components(placed, groups, ws, least, registers + 1, 0.8, registers, run=run).collect()}
        assert found == want and max(sent) <= 33 * n * (1 if run > n else 2)


def test_components(spark):
    rng = np.random.default_rng(11)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 560)]
    loose = [tuple(map(int, rng.integers(1000, 1080, 2))) for _ in range(60)]
    links = chain + star + loose + [(5, 5), (9, 8), (8, 9)]
    df = spark.createDataFrame([*links, (None, 3)], "a long, b long")
    got = {r.node: r.component for r in components(df, Workspace(spark, "t")).collect()}
    assert got == union_find({x for p in links for x in p}, links)


def test_embeddings_against_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = []
    for c in range(30):
        centre = rng.standard_normal(16)
        for _ in range(int(rng.integers(1, 12))):
            rows.append((centre + 0.04 * rng.standard_normal(16), c % 3))
    rows += [(rows[0][0] * 2, rows[0][1]), (rows[0][0], rows[0][1]), (rows[0][0], rows[0][1])]
    data = [(i, [float(np.float32(x)) for x in v], l) for i, (v, l) in enumerate(rows)]
    n = len(data)
    data += [(n, None, 0), (n + 1, [0.0] * 16, 0), (n + 2, [float("nan")] * 16, 0), (n + 3, [1.0, None], 0), (n + 4, data[0][1], None), (n + 5, [], 0), (n + 6, [float("inf")] + [0.0] * 15, 0), (None, data[0][1], 0), (n + 7, [1.0, 2.0], 0), (n + 8, [2.0, 4.0], 0)]
    df = spark.createDataFrame([(*r, "x") for r in data], "vec_id long, embedding array<float>, label int, code string")
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(df, Workspace(spark, "t"), block=8).collect()}
    links = []
    for i, a, la in data:
        for j, b, lb in data:
            if None not in (i, j) and i < j and la is not None and la == lb and a and b and len(a) == len(b) and None not in a + b:
                x, y = np.array(a), np.array(b)
                if np.isfinite(x).all() and np.isfinite(y).all() and x.any() and y.any() and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98:
                    links.append((i, j))
    want = union_find([r[0] for r in data if r[0] is not None], links)
    count = Counter(x for p in links for x in p)
    assert {i: (r.n_links, r.component_id, r.kept) for i, r in got.items() if i is not None} == {i: (count[i], c, i == c) for i, c in want.items()}
    assert got[None].n_links == 0 and len(links) > 100
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_dedup.near_duplicates(none, Workspace(spark, "t")).count() == 0


def test_embeddings_on_both_sides_of_the_threshold(spark):
    """Pairs whose cosine in double precision is next to 0.98: those below link with nothing."""
    rng = np.random.default_rng(21)
    rows, want = [], {}
    for k in range(300):
        a = rng.standard_normal(8)
        a /= np.linalg.norm(a)
        o = rng.standard_normal(8)
        o -= (o @ a) * a
        o /= np.linalg.norm(o)
        b = 0.98 * a + np.sqrt(1 - 0.98**2) * o
        b[0] = np.nextafter(b[0], np.inf if k % 2 else -np.inf)
        rows += [(2 * k, a.tolist(), k), (2 * k + 1, b.tolist(), k)]
        want[k] = embedding_dedup.cosine(a, b) >= 0.98
    got = {r.vec_id: r.n_links for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long"), Workspace(spark, "t")).collect()}
    assert 30 < sum(want.values()) < 290
    assert {k: got[2 * k] == got[2 * k + 1] == 1 for k in want} == want
    for x, y, close in (((1.0, 0.0), (0.98, math.sqrt(1 - 0.98**2)), None), ((1e300, 0.0), (1e300, 0.0), True), ((1e-300, 0.0), (0.0, 1e-300), False)):
        from fractions import Fraction as Fr

        p, q, r = (sum(Fr(u) * Fr(v) for u, v in zip(s, t)) for s, t in ((x, y), (x, x), (y, y)))
        found = embedding_dedup.cosine(np.array(x), np.array(y)) >= 0.98
        assert close is None and abs(float(p * p / (q * r)) - 0.98**2) < 1e-15 or found == close


def test_a_large_component(spark):
    """20,000 different vectors of one component: each is sent to 33 pairs of blocks at most, and every link is counted."""
    rng = np.random.default_rng(4)
    n = 20_000
    v = (np.array([10.0, 0, 0, 0]) + rng.standard_normal((n, 4))).astype(np.float32)
    sent = []

    class Counting(Workspace):
        def cut(self, df):
            out = super().cut(df)
            sent.append(out.count())
            return out

    df = spark.createDataFrame([(i, x.tolist(), 1) for i, x in enumerate(v)], "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r.n_links for r in embedding_dedup.near_duplicates(df, Counting(spark, "t")).collect()}
    x = v.astype(float) / np.linalg.norm(v.astype(float), axis=1, keepdims=True)
    probe = rng.integers(0, n, 200)
    assert [got[i] for i in probe.tolist()] == ((x[probe] @ x.T >= 0.98).sum(axis=1) - 1).tolist()
    assert max(sent) <= 33 * n


def test_embeddings_of_a_dense_label(spark):
    """One label whose vectors lie just below the threshold: most codes agree, and windows see few of the pairs."""
    rng = np.random.default_rng(8)
    n, dim = 3000, 128
    centre = rng.standard_normal(dim)
    v = (centre / np.linalg.norm(centre) + np.sqrt((1 / 0.967 - 1) / dim) * rng.standard_normal((n, dim))).astype(np.float32)
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(spark.createDataFrame([(i, x.tolist(), 0) for i, x in enumerate(v)], "vec_id long, embedding array<float>, label int"), Workspace(spark, "t")).collect()}
    x = v.astype(float) / np.linalg.norm(v.astype(float), axis=1, keepdims=True)
    close = x @ x.T >= 0.98
    np.fill_diagonal(close, False)
    want = union_find(range(n), np.argwhere(np.triu(close)).tolist())
    assert 200 < (close.sum(axis=1) > 0).sum() < n - 200
    assert sum(got[i].component_id != c for i, c in want.items()) == 0
    assert [got[i].n_links for i in range(n)] == close.sum(axis=1).tolist()


def test_labels_are_compared_in_their_own_type(spark):
    from stratagrid.llm import embedding_dedup
    from stratagrid.llm.common import Workspace

    for kind, one, two in (("double", 1.2, 1.7), ("string", "cat", "dog"), ("boolean", True, False)):
        rows = [(1, [1.0, 2.0], one), (2, [1.0, 2.0], two), (3, [1.0, 2.01], one), (4, [1.0, 2.0], None), (5, [1.0, 2.0], two)]
        df = spark.createDataFrame(rows, f"vec_id long, embedding array<float>, label {kind}")
        got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(df, Workspace(spark, "t")).collect()}
        assert got == {1: (1, 1), 3: (1, 1), 2: (1, 2), 5: (1, 2), 4: (0, 4)}, kind
