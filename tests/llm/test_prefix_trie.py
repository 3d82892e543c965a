import hashlib
import random
import zlib
from collections import defaultdict

from stratagrid.llm import prefix_trie
from stratagrid.llm.common import Workspace

SCHEMA = "conv_id long, turn long, role string, text string, depth string, salt int"


def rebuilt(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [v[2:] for v in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute(convs):
    """A row for each node, by walking all prefixes."""
    nodes = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            nodes[tuple(convs[c][:d])].append(c)
    children = defaultdict(list)
    for key in nodes:
        if key:
            children[key[:-1]].append(key)
    leaves, saved = {}, {}
    for key in sorted(nodes, key=len, reverse=True):
        leaves[key] = sum(leaves[k] for k in children[key]) if children[key] else 1
        saved[key] = (len(nodes[key]) - 1) * (len(key[-1][1].encode()) if key else 0) + sum(saved[k] for k in children[key])
    return sorted(
        (m[0], len(key), nodes[key[:-1]][0] if key else None, len(m), len(children[key]), leaves[key], saved[key], hashlib.sha256(",".join(str(c) for c in m if len(convs[c]) == len(key)).encode()).hexdigest())
        for key, m in nodes.items()
    )


def rows_of(df):
    return sorted(tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect())


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 7) for r in rows], SCHEMA).repartition(6)


def test_regrafted_trie_is_the_plain_one(spark):
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["user", "assistant"]), f"é{rng.randint(0, 1)}" * rng.randint(0, 2)) for c in range(-12, 90) for t in range(rng.choice([1, 2, 4, 9, 12]))]
    rows += [(200, None, None, None), (200, None, "user", "a"), (200, 1, "user", None), (200, 1, "user", "b"), (200, 1, "assistant", "b"), (201, 3, "user", "x")] + [(205, 2, "user", "same")] * 5 + [(None, 1, "user", "lost")]
    rows += [(c, 0, "user", "one opening of all") for c in range(1000, 1400)]  # a hot child and hot leaves
    space = Workspace(spark, "t")
    got = prefix_trie.trie(*prefix_trie.regrafted(prefix_trie.ordered(frame(spark, rows), space), space), space)
    assert rows_of(got) == brute(rebuilt(rows))


def test_a_long_conversation_is_cut_in_stretches(spark):
    rows = [(1, t, "user", "again") for t in range(300)] + [(2, t, "user", "again") for t in range(270)] + [(3, 0, "user", "x" * 100_000)]
    space = Workspace(spark, "t")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    turns = prefix_trie.ordered(frame(spark, rows), space)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert turns.where("conv_id = 1").select("seg").distinct().count() > 1
    got = prefix_trie.trie(*prefix_trie.unchanged(turns), space)
    assert rows_of(got) == brute({1: [("user", "again")] * 300, 2: [("user", "again")] * 270, 3: [("user", "x" * 100_000)]})


def test_no_conversations(spark):
    space = Workspace(spark, "t")
    for rows in ([], [(None, 1, "user", "x")]):
        assert prefix_trie.trie(*prefix_trie.regrafted(prefix_trie.ordered(frame(spark, rows), space), space), space).collect() == []
