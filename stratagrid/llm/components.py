"""Connected components by randomised contraction.

Each round every node adopts the neighbour (or itself) that comes first in a fresh
random order, and edges are rewritten to the adopted names, which shortens chains
and collapses stars by a constant factor. All joins read written tables, so that
skewed names are split by adaptive execution; the minimum per node is summed up
before its shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace


def components(edges: DataFrame, ws: Workspace, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of `edges` (a, b: long); component is the smallest node reached.

    Self-links and repeated links are allowed. Nodes without edges are not listed;
    null ends are dropped.
    """
    edges = ws.cut(edges.select("a", "b").where("a is not null and b is not null").distinct())
    names = ws.cut(edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().select("node", F.col("node").alias("name")))
    edges = edges.where("a <> b")
    for turn in range(max_rounds):
        if edges.isEmpty():
            break
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(turn)).alias("h"), F.col(c).alias("v"))
        both = edges.select(F.col("a").alias("u"), rank("b").alias("r")).union(edges.select(F.col("b").alias("u"), rank("a").alias("r")))
        adopted = both.groupBy("u").agg(F.min("r").alias("r")).select("u", F.least("r", rank("u"))["v"].alias("to"))
        adopted = ws.cut(adopted)
        a, b = (adopted.select(F.col("u").alias(c), F.col("to").alias(f"{c}_to")) for c in "ab")
        then = edges.join(a, "a").join(b, "b").where("a_to <> b_to").select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b")).distinct()
        then = ws.cut(then)
        renamed = ws.cut(names.join(adopted, names["name"] == adopted["u"], "left").select("node", F.coalesce("to", "name").alias("name")))
        ws.discard(edges, names, adopted)
        edges, names = then, renamed
    else:
        raise RuntimeError("the graph did not contract")
    smallest = ws.cut(names.groupBy("name").agg(F.min("node").alias("component")))
    return names.join(smallest, "name").select("node", "component")
