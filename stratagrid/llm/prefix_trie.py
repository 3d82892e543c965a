"""The prefix trie of conversations, and what sharing its prefixes saves.

A node is a distinct sequence of first turns (role, text), from the textless root. Its
key is a digest that can be added up: every turn gives a 128-bit hash of its place,
role and text, and a prefix's key is the sum of its turns' hashes in four lanes modulo
2^32. So keys need no pass along a conversation: a long one is cut into segments, which
are summed apart and then shifted by the segments before them. A node's parent edge is
the key without its last turn.

Subtree sums are rolled up by pointer jumping. After round k a node knows the sum over
its descendants less than 2^k levels down, and points 2^k levels up; it then adds its
sum to the node it points to, and takes that node's pointer. A trie of depth D takes
about log2(D) rounds. Nodes that point to one ancestor are first added up by salts of
their key, and pointers come back through the same salts, so a prefix that a third of
all conversations share isn't one task's work.

Rows of null conv_id belong to no conversation and are left out; null roles and texts
are empty; turns of one place (ties, repeated rows) are ordered by role and text.
Conversations without turns are members of the root. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Workspace
from .ranking import in_order, part

LANES = [f"l{i}" for i in range(4)]
LANE = 1 << 32
#: Ways in which the nodes below one ancestor are added up apart.
SALTS = 64
#: Ids of one range of this width are joined to text before they are hashed in order.
CHUNK = 1024
EMPTY = hashlib.sha256(b"").hexdigest()


def ordered(conversations: DataFrame, space: Workspace) -> DataFrame:
    """(conv_id, seg, place, total, digest, n_bytes): each turn's place from 1, and its conversation's number of turns; seg is a stretch that fits a task."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", text("role"), text("text")).where("conv_id is not null")
    laid = in_order(rows, [F.asc("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("text")], space)
    digest = F.sha2(F.concat_ws("\n", F.octet_length("role").cast("string"), "role", "text"), 256)
    turns = laid.select("conv_id", part().alias("seg"), "at", digest.alias("digest"), F.octet_length("text").cast("long").alias("n_bytes"))
    segments = turns.groupBy("conv_id", "seg").agg(F.min("at").alias("begin"), F.count("*").alias("n"))
    of = Window.partitionBy("conv_id")
    before = F.coalesce(F.sum("n").over(of.orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    segments = segments.withColumns({"before": before, "total": F.sum("n").over(of)})  # a row for each stretch of each conversation
    place = F.col("before") + F.col("at") - F.col("begin") + 1
    return space.cut(turns.join(segments, ["conv_id", "seg"]).select("conv_id", "seg", place.alias("place"), "total", "digest", "n_bytes"))


def regrafted(turns: DataFrame, space: Workspace, every: int = 5, reach: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that take their first turns from another one, as (steps, members) for `trie`.

    Conversation c gets the first h turns of conversation c - c % every, and keeps its
    own after its first h, with h = crc32(c) % reach. The heads are at most reach - 1
    turns a conversation; what is known of a conversation meets its turns by stretches.
    """
    heads = turns.where(F.col("place") < reach).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("place", "digest", "n_bytes"))).alias("head"))
    known = turns.groupBy("conv_id").agg(F.max("total").alias("total"))
    known = known.withColumn("h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % reach).cast("int"))
    heads = heads.withColumnRenamed("conv_id", "base")
    known = known.join(heads, F.col("conv_id") - F.col("conv_id") % every == F.col("base"), "left")
    known = known.withColumn("shared", F.when(F.col("head").isNull() | (F.col("h") == 0), F.array().cast(heads.schema["head"].dataType)).otherwise(F.slice("head", F.lit(1), F.greatest("h", F.lit(1)))))
    n_turns = F.size("shared") + F.greatest(F.col("total") - F.col("h"), F.lit(0))
    known = space.cut(known.select("conv_id", "h", "shared", F.size("shared").alias("k"), n_turns.cast("long").alias("n_turns")))
    taken = known.select("conv_id", "n_turns", F.explode("shared").alias("x")).select("conv_id", F.lit(-1).cast("long").alias("seg"), F.col("x.place").alias("place"), "n_turns", "x.digest", "x.n_bytes")
    where = turns.select("conv_id", "seg").distinct().join(known.select("conv_id", "h", "k", "n_turns"), "conv_id")
    own = turns.join(where, ["conv_id", "seg"]).where("place > h")
    own = own.select("conv_id", "seg", (F.col("place") - F.col("h") + F.col("k")).alias("place"), "n_turns", "digest", "n_bytes")
    return taken.unionByName(own), known.select("conv_id", "n_turns")


def unchanged(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(steps, members) of conversations as they are."""
    return turns.withColumnRenamed("total", "n_turns"), turns.groupBy("conv_id").agg(F.max("total").alias("n_turns"))


def _key(lanes: list[Column]) -> tuple[Column, Column]:
    high = lambda a, b: F.shiftleft(a % LANE, 32).bitwiseOR(b % LANE)
    return high(lanes[0], lanes[1]), high(lanes[2], lanes[3])


def prefixes(steps: DataFrame, space: Workspace) -> DataFrame:
    """(conv_id, depth, k1, k2, p1, p2, n_bytes, last): each prefix's key and its parent's."""
    hashed = F.sha2(F.concat_ws(":", F.col("place").cast("string"), "digest"), 256)
    steps = steps.withColumn("__h", hashed)
    steps = steps.withColumns({n: F.conv(F.substring("__h", 8 * i + 1, 8), 16, 10).cast("long") for i, n in enumerate(LANES)})
    so_far = Window.partitionBy("conv_id", "seg").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = steps.select("conv_id", "seg", "place", "n_turns", "n_bytes", *LANES, *(F.sum(n).over(so_far).alias(f"r_{n}") for n in LANES))
    steps = space.cut(steps)
    sums = steps.groupBy("conv_id", "seg").agg(*((F.sum(n) % LANE).alias(f"s_{n}") for n in LANES))
    earlier = Window.partitionBy("conv_id").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("conv_id", "seg", *(F.coalesce(F.sum(f"s_{n}").over(earlier), F.lit(0)).alias(f"o_{n}") for n in LANES))
    steps = steps.join(sums, ["conv_id", "seg"])
    k1, k2 = _key([F.col(f"r_{n}") + F.col(f"o_{n}") for n in LANES])
    p1, p2 = _key([F.col(f"r_{n}") + F.col(f"o_{n}") - F.col(n) for n in LANES])
    return steps.select("conv_id", F.col("place").alias("depth"), k1.alias("k1"), k2.alias("k2"), p1.alias("p1"), p2.alias("p2"), "n_bytes", (F.col("place") == F.col("n_turns")).alias("last"))


def _salt() -> Column:
    return F.pmod(F.xxhash64("k1", "k2"), F.lit(SALTS)).alias("salt")


def rolled_up(nodes: DataFrame, values: list[str], space: Workspace) -> DataFrame:
    """`nodes` (k1, k2, p1, p2, depth and values) with each value summed over the node's subtree, by pointer jumping."""
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    state = nodes.select("k1", "k2", "depth", F.col("p1").alias("q1"), F.col("p2").alias("q2"), _salt(), *values)
    span = 1
    while span <= deepest:
        sent = space.cut(state.where(F.col("depth") >= span).groupBy("q1", "q2", "salt").agg(*(F.sum(v).alias(v) for v in values)))
        got = sent.groupBy(F.col("q1").alias("k1"), F.col("q2").alias("k2")).agg(*(F.sum(v).alias(f"got_{v}") for v in values))
        grown = state.join(got, ["k1", "k2"], "left").select("k1", "k2", "depth", "q1", "q2", "salt", *(F.col(v) + F.coalesce(f"got_{v}", F.lit(0)) for v in values))
        grown = grown.toDF("k1", "k2", "depth", "q1", "q2", "salt", *values)
        further = state.where(F.col("depth") >= span).select(F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("q1").alias("n1"), F.col("q2").alias("n2"))
        jumps = sent.select("q1", "q2", "salt").join(further, ["q1", "q2"])
        still = grown.where(F.col("depth") >= 2 * span).join(jumps, ["q1", "q2", "salt"])
        still = still.select("k1", "k2", "depth", F.col("n1").alias("q1"), F.col("n2").alias("q2"), "salt", *values)
        before, state = state, space.cut(still.unionByName(grown.where(F.col("depth") < 2 * span)))
        space.discard(sent, *([before] if span > 1 else []))
        span *= 2
    return state.select("k1", "k2", *values)


def ends_digests(ends: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256) of (k1, k2, conv_id): the ids of a node in order, joined by commas; ranges of ids are joined first and hashed one after the other."""
    texts = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    chunks = ends.groupBy("k1", "k2", F.floor(F.col("conv_id") / CHUNK).alias("chunk")).agg(texts.alias("ids"))  # at most CHUNK ids
    laid = chunks.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "chunk").select("k1", "k2", "ids")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, h = None, None
        for batch in batches:
            done = []
            for k1, k2, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if (k1, k2) != key:
                    if key is not None:
                        done.append((*key, h.hexdigest()))
                    key, h = (k1, k2), hashlib.sha256()
                else:
                    h.update(b",")
                h.update(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["k1", "k2", "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, h.hexdigest())], names=["k1", "k2", "ends_sha256"])

    return laid.mapInArrow(digest, "k1 long, k2 long, ends_sha256 string")


def trie(steps: DataFrame, members: DataFrame, space: Workspace) -> DataFrame:
    """One row for each node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    steps: (conv_id, seg, place, n_turns, digest, n_bytes), seg ascending with place;
    members: (conv_id, n_turns) of all conversations, those without turns too. What a
    node saves is (n_convs - 1) times the bytes of its last text.
    """
    paths = space.cut(prefixes(steps, space))
    grouped = paths.groupBy("k1", "k2").agg(*(F.min(c).alias(c) for c in ("p1", "p2", "depth", "n_bytes", "conv_id")), F.count("*").alias("n_convs"))
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = members.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(zero.alias("k1"), zero.alias("k2"), none.alias("p1"), none.alias("p2"), zero.alias("depth"), zero.alias("n_bytes"), "conv_id", "n_convs")
    nodes = space.cut(grouped.unionByName(root).withColumn("salt", _salt()))
    below = space.cut(nodes.where("depth > 0").groupBy("p1", "p2", "salt").agg(F.count("*").alias("n")))
    children = below.groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.sum("n").alias("n_children"))
    counted = nodes.join(children, ["k1", "k2"], "left").withColumn("n_children", F.coalesce("n_children", zero))
    counted = counted.withColumns({"n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("n_bytes")})
    counted = space.cut(counted)
    sums = rolled_up(counted, ["n_leaves", "saved_tokens"], space)
    above = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    parents = below.select("p1", "p2", "salt").join(above, ["p1", "p2"])
    named = counted.drop("n_leaves", "saved_tokens")
    named = reduce(DataFrame.unionByName, [named.where("depth > 0").join(parents, ["p1", "p2", "salt"]), named.where("depth = 0").withColumn("parent_conv_id", none)])
    ends = paths.where("last").select("k1", "k2", "conv_id").union(members.where("n_turns = 0").select(zero, zero, "conv_id"))
    found = named.join(sums, ["k1", "k2"]).join(ends_digests(ends), ["k1", "k2"], "left")
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))


ORACLE_SQL = r"""
with tab as (select list_transform(range(256), lambda i: list_reduce([i::ubigint] || list_transform(range(8), lambda z: 0::ubigint), lambda x, z: xor(x >> 1, (x & 1::ubigint) * 3988292384::ubigint))) t),
o as materialized (select conv_id, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) place, coalesce(role, '') r, coalesce(text, '') x from conversations where conv_id is not null),
c as materialized (select conv_id, (xor(list_reduce([4294967295::ubigint] || list_transform(range(length(conv_id::varchar)), lambda i: ord(substr(conv_id::varchar, i + 1, 1))::ubigint), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255::ubigint)::bigint + 1])), 4294967295::ubigint) % 9)::bigint h
  from (select distinct conv_id from o), tab),
s as materialized (select conv_id, row_number() over (partition by conv_id order by own, place) depth, r, x from (
  select c.conv_id, 0 own, o.place, o.r, o.x from c join o on o.conv_id = c.conv_id - c.conv_id % 5 where o.place <= h
  union all select c.conv_id, 1, o.place, o.r, o.x from c join o on o.conv_id = c.conv_id where o.place > h)),
p as materialized (select conv_id, depth, strlen(x) n_bytes, sha256(string_agg(strlen(r) || ':' || r || strlen(x) || ':' || x, '' order by depth) over (partition by conv_id order by depth)) k from s
  union all select conv_id, 0, 0, '' from c),
l as (select conv_id, max(depth) n from p group by 1),
n as materialized (select k, depth, min(p.conv_id) conv_id, count(*) n_convs, any_value(n_bytes) n_bytes,
  sha256(coalesce(string_agg(p.conv_id::varchar, ',' order by p.conv_id) filter (p.depth = l.n), '')) ends_sha256 from p join l using (conv_id) group by 1, 2),
e as materialized (select n.k, q.k parent from n join p q on q.conv_id = n.conv_id and q.depth = n.depth - 1),
f as (select parent k, count(*) n_children from e group by 1),
v as materialized (select n.*, coalesce(n_children, 0) n_children from n left join f using (k)),
u as (select q.k, count(*) filter (v.n_children = 0) n_leaves, sum((v.n_convs - 1) * v.n_bytes) saved_tokens from v join p q on q.conv_id = v.conv_id and q.depth <= v.depth group by 1)
select v.conv_id, v.depth::bigint as depth, a.conv_id parent_conv_id, v.n_convs, v.n_children::bigint n_children, u.n_leaves, u.saved_tokens::bigint saved_tokens, v.ends_sha256
from v join u using (k) left join e using (k) left join n a on a.k = e.parent
"""
