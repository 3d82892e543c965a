import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from stratagrid.llm import maxent_lm as lm
from stratagrid.llm.common import Workspace

TOKEN = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(t):
    return TOKEN.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [lm.END]


def is_held_out(d):
    return d is None or zlib.crc32(str(d).encode()) % 7 == 2


def corpus():
    rng = random.Random(6)
    chain = {w: rng.sample([f"w{i}" for i in range(30)], 4) for w in [f"w{i}" for i in range(30)]}
    docs = []
    for d in range(240):
        w = rng.choice(list(chain))
        words = []
        for _ in range(rng.randint(5, 60)):
            words.append(w if rng.random() > 0.05 else f"rare{rng.randint(0, 400)}")
            w = rng.choice(chain[w])
        docs.append((d, " ".join(words)))
    odd = [None, "", " \t\n", "É ÀB c", "x" * 65 + " " + "x" * 64, "X" * 65, "a\x0bb\x0cc\rd", "word " * 300, "z" * 50_000, "never seen"]
    return docs + [(1000 + i, t) for i, t in enumerate(odd)] + [(1000 + i, t) for i, t in enumerate(odd)] + [(None, "w1 w2"), (None, None)]


def plain(docs, lex, w):
    """Every column by loops over tokens; only the weights are taken from the operator."""
    seen = Counter(t for d, x in docs if not is_held_out(d) for t in tokens(x))
    n, v = sum(seen.values()), len(seen)
    symbol = {t: i + 2 for i, t in enumerate(lex.words)} | {lm.END: lm.LAST}
    rest = sum(c + 1 for t, c in seen.items() if t not in symbol) + 1

    def log_p(two, one, y):
        out = 0.0
        for node, target in ((0, y // lm.WIDTH), (1 + y // lm.WIDTH, y % lm.WIDTH)):
            rows = [int(r[0]) for r in lm.feature_rows(np.array([one]), np.array([two]), np.array([node]))]
            z = [sum(float(w[r, k]) for r in rows) for k in range(lm.WIDTH)]
            out += z[target] - math.log(sum(math.exp(x) for x in z))
        return out / math.log(10)

    for d, x in docs:
        base = score = 0.0
        one = two = lm.START
        known = 0
        for t in tokens(x):
            c = seen[t]
            known += c > 0
            base += math.log10((c + 1) / (n + v + 1))
            y = symbol.get(t, lm.OTHER)
            score += log_p(two, one, y) + (math.log10((c + 1) / rest) if y == lm.OTHER else 0.0)
            one, two = y, one
        yield d, is_held_out(d), len(tokens(x)), known, n, base, score


def model(spark, docs):
    frame = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, n int").repartition(5)
    space = Workspace(spark, "t")
    counts = space.cut(lm.token_counts(frame.where(~lm.held_out("doc_id"))))
    lex = lm.lexicon(counts)
    encoded = space.cut(lm.encode(frame, lex))
    w = lm.train(encoded, lex)
    return lex, encoded, w, lm.score(encoded, counts, lex, w)


def test_scores_are_the_plain_ones_and_beat_unigrams(spark):
    docs = corpus()
    lex, encoded, w, scored = model(spark, docs)
    order = lambda r: tuple((x is not None, x) for x in r)
    got, want = sorted((tuple(r) for r in scored.collect()), key=order), sorted(plain(docs, lex, w), key=order)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:5] == b[:5]
        assert np.allclose(a[5:], b[5:], rtol=1e-5, atol=1e-4), (a, b)
    unseen = [r for r in got if r[1] and r[0] is not None and r[0] < 240]
    assert sum(r[6] for r in unseen) / sum(r[5] for r in unseen) < 0.9

    # the symbols' probabilities after any two tokens add up to one
    for two, one in ((lm.START, lm.START), (3, 7), (lm.OTHER, 12)):
        y = np.arange(lm.WIDTH * lm.WIDTH)
        assert abs(np.exp(lm.log_probabilities(w, (two << 22) | (one << 11) | y)).sum() - 1) < 1e-4


def test_few_frequent_tokens_meet_by_a_join(spark, monkeypatch):
    docs = corpus()
    monkeypatch.setattr(lm, "SHARE", 20)
    lex, _, w, scored = model(spark, docs)
    assert 0 < len(lex.words) <= 20
    want = Counter((d, h, t, k, n, round(b, 4)) for d, h, t, k, n, b, _ in plain(docs, lex, w))
    got = Counter((*r[:5], round(r[5], 4)) for r in scored.collect())
    assert got == want


def test_gradient_counts_every_event(spark):
    rng = np.random.default_rng(2)
    ids = [rng.integers(0, 40, n).astype(np.uint16).tobytes() for n in (1, 2, 3, 50)]
    lex = lm.Lexicon(0, 0, *(np.zeros(0, t) for t in (np.uint64, np.int64, np.int64)), np.ones(40), (), 0, 1.0)
    w = lm.first_weights(lex)
    w[lm.BIASES :] = rng.normal(0, 0.1, w[lm.BIASES :].shape)
    observed, expected = lm.gradient(spark.createDataFrame([(x,) for x in ids], "ids binary").repartition(2), w)
    want_o, want_e = np.zeros(w.shape), np.zeros(w.shape)
    for raw in ids:
        one = two = lm.START
        for y in np.frombuffer(raw, np.uint16).astype(int).tolist():
            for node, target in ((0, y // lm.WIDTH), (1 + y // lm.WIDTH, y % lm.WIDTH)):
                rows = [int(r[0]) for r in lm.feature_rows(np.array([one]), np.array([two]), np.array([node]))]
                p = np.exp(sum(w[r].astype(float) for r in rows))
                for r in rows:
                    want_o[r, target] += 1
                    want_e[r] += p / p.sum()
            one, two = y, one
    assert np.allclose(observed, want_o) and np.allclose(expected, want_e, atol=1e-3)


def test_nothing_to_learn_from(spark):
    for docs in ([], [(None, "a b")]):
        *_, scored = model(spark, docs)
        assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in scored.collect()] == [(3, 0, 0, 0.0)][: len(docs)]
