import hashlib
import random
import re
from collections import Counter

from stratagrid.llm import decontaminate, license_scan, secret_scan
from stratagrid.llm.common import Workspace

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, items):
    windows = {}
    for i, t in items:
        w = words(t)
        for j in range(max(1, len(w) - 12)) if w else []:
            windows.setdefault(tuple(w[j : j + 13]), set()).add(str(i))
    for d, t in docs:
        w = words(t)
        hit, found = [0] * len(w), set()
        for n in {len(k) for k in windows}:
            for j in range(len(w) - n + 1):
                if (k := tuple(w[j : j + n])) in windows:
                    found |= windows[k]
                    hit[j : j + n] = [1] * n
        yield d, len(w), sum(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), sum(hit) > 0 and 20 * sum(hit) >= len(w)


def test_decontamination(spark):
    rng = random.Random(4)
    pool = ["the", "of", "and", *(f"w{i}" for i in range(40)), "É", "日本"]
    items = [(i, " ".join(rng.choices(pool, k=rng.choice([1, 5, 13, 14, 30])))) for i in range(30)] + [(99, None), (98, ""), (97, "the " * 30), (96, items_text := "Alpha beta, gamma"), (95, items_text)]
    docs = []
    for d in range(60):
        parts = [" ".join(rng.choices(pool, k=rng.randint(0, 60)))]
        if d % 3 == 0:
            parts.insert(rng.randint(0, 1), rng.choice(items)[1] or "")
        docs.append((d, " ".join(parts)))
    docs += [(100, None), (101, ""), (102, "the " * 500), (103, "ALPHA-beta gamma"), (103, "ALPHA-beta gamma"), (None, "nothing here")]
    df = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, terms int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for size in (decontaminate.BLOCK_BYTES, 300):
        got = decontaminate.contamination(decontaminate.benchmark_matches(df, bench, Workspace(spark, "t"), block_bytes=size))
        got = [tuple(r) for r in got.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()]
        assert sorted(map(str, got)) == sorted(map(str, brute(docs, items)))
    empty = decontaminate.benchmark_matches(df.where("false"), bench, Workspace(spark, "t"))
    assert empty.count() == 0
    nothing = decontaminate.contamination(decontaminate.benchmark_matches(df, bench.where("false"), Workspace(spark, "t")))
    assert nothing.where("n_hit > 0 or contaminated").count() == 0 and nothing.count() == len(docs)


def test_proximity_against_brute_force(spark):
    """The three rarest distinct words of a window within 24 words of the rarest, in one document and any order."""
    rng = random.Random(6)
    pool = ["the", "of", *(f"w{i}" for i in range(60))]
    weights = [20, 10, *(60 / (i + 3) for i in range(60))]
    items = [(i, " ".join(rng.choices(pool, weights, k=rng.choice([1, 2, 13, 20])))) for i in range(12)]
    docs = [(d, " ".join(rng.choices(pool, weights, k=rng.randint(0, 90)))) for d in range(40)] + [(50, "alpha beta"), (51, "gamma"), (52, "gamma x alpha y beta"), (53, f"gamma {'x ' * 24} alpha beta"), (54, f"gamma {'x ' * 30} alpha beta")]
    items += [(20, "alpha beta gamma delta"), (21, "alpha beta gamma")]
    frequency = Counter(w for _, t in docs for w in words(t))
    want = {d: set() for d, _ in docs}
    for i, t in items:
        w = words(t)
        for j in range(max(1, len(w) - 12)):
            part = w[j : j + 13]
            rare = sorted(dict.fromkeys(part), key=lambda x: (frequency[x], part.index(x)))[:3]
            for d, text in docs:
                v = words(text)
                if any(x == rare[0] and all(r in v[max(0, p - 24) : p + 25] for r in rare) for p, x in enumerate(v)):
                    want[d].add(str(i))
    assert want[50] == want[51] == set() and want[52] == {"21"} and want[54] == set()
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for size in (decontaminate.BLOCK_BYTES, 20):
        got = {r.doc_id: set(r.near_items) for r in decontaminate.benchmark_matches(df.coalesce(1), bench, Workspace(spark, "t"), block_bytes=size).collect()}
        assert got == want


def test_words_of_equal_sums_differ(spark):
    """Two long words whose polynomial codes modulo 2 ** 64 are equal in any base are two words."""
    one = "".join("ab"[i.bit_count() % 2] for i in range(2048))
    two = one.translate({97: "b", 98: "a"})
    df = spark.createDataFrame([(1, f"{one} {two} {one}"), (2, one), (3, two)], "doc_id long, text string")
    found = decontaminate.benchmark_matches(df, spark.createDataFrame([(1, two)], "item_id long, text string"), Workspace(spark, "t"))
    assert {r.doc_id: [tuple(s) for s in r.spans] for r in found.collect()} == {1: [(1, 2)], 2: [], 3: [(0, 1)]}


def test_decontamination_keeps_rows_and_counts_items_once(spark):
    """Any number of blocks: repeated rows and null doc_ids stay apart, and two rows of one item_id are one item."""
    texts = [" ".join(f"{c}{i}" for i in range(14)) for c in "abcd"]
    items = [(1, texts[0]), (1, texts[1]), (2, texts[2]), (2, texts[2]), (3, texts[3])]
    docs = [(None, texts[0]), (None, texts[2]), (None, " ".join(f"z{i}" for i in range(14))), (5, f"{texts[0]} {texts[1]}"), (5, f"{texts[0]} {texts[1]}"), (5, f"{texts[2]} {texts[3]}"), (6, "x"), (6, "x"), (7, None)]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for size in (decontaminate.BLOCK_BYTES, 100):
        got = decontaminate.contamination(decontaminate.benchmark_matches(df, bench, Workspace(spark, "t"), block_bytes=size))
        got = [tuple(r) for r in got.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()]
        assert sorted(map(str, got)) == sorted(map(str, brute(docs, items)))


def test_licenses(spark):
    assert all(license_scan.words(t) for t in license_scan.TEMPLATES.values())
    pad = "lorem ipsum dolor sit amet " * 30
    docs = [(i, f"{pad}{t} {pad}", n) for i, (n, t) in enumerate(license_scan.TEMPLATES.items())]
    long = license_scan.TEMPLATES["ISC"].replace("fee", "charge").replace("any purpose", "every purpose")
    docs += [(100, None, ""), (101, "", ""), (102, "license", ""), (103, pad + "the license is provided with software", ""), (104, f"{pad} {long}", "ISC"), (105, "released UNDER the mit-license", "MIT"), (105, "released under the MIT license", "MIT")]
    df = spark.createDataFrame([(d, t, 1) for d, t, _ in docs], "doc_id long, text string, band int")
    got = {(r.doc_id, r.license): r.containment for r in license_scan.license_matches(df).collect()}
    known = {n: license_scan.shingles(license_scan.words(t)) for n, t in license_scan.TEMPLATES.items()}
    want = {}
    for d, t, _ in docs:
        have = license_scan.shingles(license_scan.words(t or ""))
        want |= {(d, n): round(len(k & have) / len(k), 6) for n, k in known.items() if len(k & have) >= 0.8 * len(k)}
    assert got == want and all((d, n) in got for d, _, n in docs if n and d != 104)
    assert license_scan.license_matches(df.where("false")).count() == 0


def test_whole_licenses_and_long_texts(spark):
    """Texts and templates of any length, against containment in every window; repeated and null doc_ids are one document."""
    rng = random.Random(7)
    long = " ".join(rng.choices([f"z{i}" for i in range(3000)], k=2500)) + " license"
    templates = {"MIT-whole": license_scan.TEMPLATES["MIT-whole"], "Zlib-text": license_scan.TEMPLATES["Zlib-text"], "long": long, "MIT": license_scan.TEMPLATES["MIT"]}
    pad = lambda n: " ".join(rng.choices(["lorem", "ipsum", "dolor", "amet", "license", "software", "provided"], k=n))
    worn = lambda t, share: " ".join("x" if rng.random() < share else w for w in t.split())
    docs = [(k, f"{pad(rng.randint(0, 400))} {worn(t, share)} {pad(rng.randint(0, 400))}") for k, (t, share) in enumerate((t, share) for t in templates.values() for share in (0, 0.01, 0.02, 0.05, 0.2))]
    docs += [(50, pad(30000) + templates["MIT-whole"]), (51, None), (51, templates["MIT"]), (51, pad(9) + " " + templates["MIT"]), (None, templates["Zlib-text"]), (None, templates["MIT"])]
    want = {}
    for d, t in docs:
        w = license_scan.words(t or "")
        for name, template in templates.items():
            known = license_scan.shingles(license_scan.words(template))
            _, stride, size = license_scan.length_class(len(license_scan.words(template)))
            at = {s for p in range(len(w) - 4) if " ".join(w[p : p + 5]) in known for s in range(max(0, -(-(p + 5 - size) // stride)), p // stride + 1)}
            for s in at:
                share = len(known & license_scan.shingles(w[s * stride : s * stride + size])) / len(known)
                if share >= 0.8:
                    best, first = want.get((d, name), (0, 10**9))
                    want[d, name] = max(best, round(share, 6)), min(first, s * stride)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.doc_id, r.license): (r.containment, r.first_word) for r in license_scan.license_matches(df, templates).collect()}
    assert got == want and {n for _, n in want} == set(templates)


def base(text):
    text = text or ""
    assign = re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.A)
    found = [(m.start(), 0, m.end()) for m in assign if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def test_secrets(spark):
    rng = random.Random(9)
    pieces = ["password", "Passwd", "secret", "TOKEN", "apikey", "api_key", "=", ":", " ", '"', "'", "abc", "hunter2hunter2", "AKIA", "ABCDEFGH12345678", "deadbeef" * 3, "é", "😀", "\n", "x.y/z", "user=bob1", "https://h.example/p"]
    docs = [(i, "".join(rng.choices(pieces, k=rng.randint(0, 25)))) for i in range(400)]
    docs += [(1000, None), (1001, ""), (None, "token=abcdefgh"), (1002, "secret=token: abcdefgh"), (1003, "secret=abcdefg " * 2000), (1003, "secret=abcdefg " * 2000)]
    df = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, base int")
    got = {r.doc_id: r for r in secret_scan.secret_spans(df, Workspace(spark, "t")).collect()}
    for i, t in docs:
        assert [tuple(s) for s in got[i].base] == base(t), (i, t)
    assert secret_scan.secret_spans(df, Workspace(spark, "t")).count() == len(docs)
    assert secret_scan.secret_spans(df.where("false"), Workspace(spark, "t")).count() == 0


def test_linking(spark):
    key = "Zq9" * 12
    docs = [
        (1, f"user=alice then {key}"),  # both weak, both reported
        (2, f"just {key}"),
        (3, "user=alice at https://h.example/p"),  # no secret
        (4, f"user=alice {'word ' * 100} {key}"),  # too far
        (5, "password=hunter22 at https://h.example/p"),
        (6, "x secret=https://h.example/p"),  # an endpoint inside a base span stays base
        (7, f"AKIA{'A' * 16} and {key}"),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.spans for r in secret_scan.secret_report(secret_scan.secret_spans(df, Workspace(spark, "t"))).collect()}
    assert got[1] == "name:0:10,token:16:52" and got[2] == got[3] == got[4] == ""
    assert got[5] == "assign:0:17,endpoint:21:40" and got[7] == "access:0:20,token:25:61"
    assert "endpoint" in got[6] or got[6] == ""
