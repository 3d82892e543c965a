"""Near-duplicate embeddings by sorted projection passes.

In every pass a vector gets the signs of `BITS` random projections as its code. All
passes are sorted together by (pass, label, code), each vector is compared with the
next `WINDOW` vectors of its pass and label, and what verified pairs connect leaves a
task as a spanning forest, so that a dense group of n vectors emits n links per pass
and not n * n. The union over passes gives components. In a dense label most codes
agree, and a window sees few of the vectors that it should; so runs of vectors whose
codes agree in their first bits are then compared across components, in blocks,
however long a run is. Inside each component blocks of vectors are compared with each
other by matrix products to count every link exactly.

Runs agree in ceil(log2(n / WINDOW)) bits for n vectors of a label, so that unrelated
vectors make runs of WINDOW at most on average. A pair of different components is
compared if it shares a run in any pass, whatever other vectors there are and wherever
a window or a task of the sorted passes ends. A pair at
the threshold (cosine 0.98) differs in a sign with probability 0.064; with 16 passes
it shares no run with probability 0.000003 at n = 10,000 and 0.014 at 100 million,
closer pairs far less. A run costs the product of its vectors outside its largest
component and all its vectors: a label of m vectors that all lie just below the
threshold costs m * m, which is what it takes to tell them apart.

Two vectors link if their cosine, sum(x y) / sqrt(sum(x x) sum(y y)) with each sum
rounded once from its exact value, is the threshold or more. Products of unit vectors
decide all pairs but those within `NEAR` of the threshold, for which it is computed.

Equal vectors of a label are one class with a multiplicity from the start. A block has
`BLOCK` vectors, more where this would send a vector to over `COPIES` pairs of blocks,
up to `LARGEST`; so a group of n sends at most n * max(COPIES, n / LARGEST) rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Workspace
from .components import components

THRESHOLD = 0.98
PASSES, BITS, WINDOW = 16, 32, 32
BLOCK, COPIES, LARGEST = 512, 32, 8192
#: Vectors of one length whose codes agree in their first bits.
RUN = ["pass", "label", "dim", "prefix"]
#: More than the rounding of a product of unit vectors.
NEAR = 1e-12


def cosine(x: np.ndarray, y: np.ndarray) -> float:
    x, y = (np.ldexp(v.astype(np.float64), -np.frexp(np.abs(v).max())[1]) for v in (x, y))  # exact, and nothing overflows
    return math.fsum(x * y) / math.sqrt(math.fsum(x * x) * math.fsum(y * y))


def linked(x: np.ndarray, y: np.ndarray, raw_x: list, raw_y: list, threshold: float) -> np.ndarray:
    """Which of the unit vectors x and y (rows), made from raw_x and raw_y, have a cosine of `threshold` or more."""
    close = np.empty((len(x), len(y)), dtype=bool)
    for at in range(0, len(x), 512):
        dots = x[at : at + 512] @ y.T
        close[at : at + 512] = dots >= threshold
        for i, j in np.argwhere(np.abs(dots - threshold) < NEAR).tolist():
            close[at + i, j] = cosine(raw_x[at + i], raw_y[j]) >= threshold
    return close


def block_size(n: Column, block: int) -> Column:
    """Vectors of a block in a group of n."""
    return F.greatest(F.lit(block), F.least(F.lit(LARGEST), F.ceil(n / COPIES)))


def unit(vectors: np.ndarray) -> np.ndarray:
    v = vectors.astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array) -> list[np.ndarray]:
    """Vectors of a list column; lengths may differ."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    at = np.r_[0, np.cumsum(np.asarray(column.value_lengths().fill_null(0)))]
    return [flat[s:e] for s, e in zip(at[:-1], at[1:])]


def _codes(passes: int, bits: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            vectors = _matrix(batch.column(2))
            size = np.array([len(v) for v in vectors])
            code = np.zeros((len(vectors), passes), dtype=np.int64)
            for dim in np.unique(size).tolist():
                if dim not in planes:
                    planes[dim] = np.random.default_rng([seed, dim]).standard_normal((dim, passes * bits))
                rows = np.flatnonzero(size == dim)
                signs = (unit(np.stack([vectors[r] for r in rows])) @ planes[dim] > 0).reshape(len(rows), passes, bits)
                code[rows] = signs @ (1 << np.arange(bits - 1, -1, -1, dtype=np.int64))
            codes = pa.ListArray.from_arrays(np.arange(len(vectors) + 1, dtype=np.int32) * passes, pa.array(code.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(size, pa.int32()), codes], ["rep", "label", "v", "dim", "codes"])

    return run


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Of n nodes, the smallest node each is connected to by links (a, b)."""
    name = np.arange(n)
    while True:
        low = np.minimum(name[a], name[b])
        new = name.copy()
        np.minimum.at(new, name[a], low)
        np.minimum.at(new, name[b], low)
        new = new[new[name]]
        if (new == name).all():
            return name
        name = new


def _neighbours(window: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            rows = rows.combine_chunks()
            held = rows.slice(max(0, len(rows) - window))
            vectors = _matrix(rows["v"].combine_chunks() if rows["v"].num_chunks != 1 else rows["v"].chunk(0))
            size = np.array([len(v) for v in vectors])
            group = np.column_stack([rows["pass"].to_numpy(), rows["label"].to_numpy(), size])
            rep = rows["rep"].to_numpy()
            wide = np.zeros((len(vectors), size.max(initial=1)), dtype=np.float64)
            for dim in np.unique(size).tolist():
                at = np.flatnonzero(size == dim)
                wide[at, :dim] = unit(np.stack([vectors[r] for r in at]))
            found = []
            for step in range(1, min(window, len(vectors) - 1) + 1):
                same = np.flatnonzero((group[:-step] == group[step:]).all(axis=1))
                dots = np.einsum("ij,ij->i", wide[same], wide[same + step])
                close = dots >= threshold
                for k in np.flatnonzero(np.abs(dots - threshold) < NEAR).tolist():
                    close[k] = cosine(vectors[same[k]], vectors[same[k] + step]) >= threshold
                i = same[close]
                found.append(np.column_stack([i, i + step]))
            pairs = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
            name = _forest(pairs[:, 0], pairs[:, 1], len(vectors))
            moved = np.flatnonzero(name != np.arange(len(vectors)))
            yield pa.RecordBatch.from_arrays([pa.array(rep[name[moved]]), pa.array(rep[moved])], ["a", "b"])

    return run


def _across(threshold: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = [np.zeros((0, 2), np.int64)]
        pdf = pdf.sort_values([*RUN, "lo", "hi"])
        key = pdf[[*RUN, "lo", "hi"]].to_numpy()
        edges = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1), True])
        comp, block, v = pdf.component.to_numpy(), pdf.block.to_numpy(), pdf.v.to_numpy()
        for s, e in zip(edges[:-1], edges[1:]):
            x, c = unit(np.stack(v[s:e])), comp[s:e]
            one, two = np.flatnonzero(block[s:e] == key[s, -2]), np.flatnonzero(block[s:e] == key[s, -1])
            i, j = np.nonzero(linked(x[one], x[two], v[s:e][one], v[s:e][two], threshold) & (c[one][:, None] != c[two][None, :]))
            if len(i):
                nodes, at = np.unique(c, return_inverse=True)
                name = _forest(at[one[i]], at[two[j]], len(nodes))
                moved = np.flatnonzero(name != np.arange(len(nodes)))
                out.append(np.column_stack([nodes[name[moved]], nodes[moved]]))
        return pd.DataFrame(np.unique(np.concatenate(out), axis=0), columns=["a", "b"])

    return run


def across_components(coded: DataFrame, found: DataFrame, ws: Workspace, threshold: float, bits: int, window: int, block: int) -> DataFrame:
    """Links (a, b) between components, by all pairs of different ones that share a run.

    The members outside a run's largest component are compared with all of it, block by
    block inside tasks of bounded size; a task emits a spanning forest of components.
    """
    sizes = coded.groupBy("label", "dim").agg(F.count("*").alias("n"))
    free = F.greatest(F.lit(0), F.lit(bits) - F.ceil(F.log2(F.col("n") / window))).cast("int")
    sizes = sizes.select("label", "dim", F.when(F.col("n") <= window, F.lit(bits)).otherwise(free).alias("free"))
    named = coded.select("rep", "label", "dim", "codes").join(found.withColumnRenamed("node", "rep"), "rep", "left").join(sizes, ["label", "dim"])
    member = named.select("rep", "label", "dim", "free", F.coalesce("component", "rep").alias("component"), F.posexplode("codes").alias("pass", "code"))
    member = ws.cut(member.select("rep", "label", "dim", "component", "pass", F.expr("shiftright(code, free)").alias("prefix")))
    runs = member.groupBy(*RUN, "component").agg(F.count("*").alias("n"))
    runs = runs.groupBy(*RUN).agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("n")).where("n > top.n")
    small = F.col("n") <= block  # one block for all
    size = block_size(F.col("n"), block)
    outside = F.when(small, F.lit(1)).otherwise(F.ceil((F.col("n") - F.col("top.n")) / size)).cast("long")
    inside = F.when(small, F.lit(0)).otherwise(F.ceil(F.col("top.n") / size)).cast("long")
    runs = ws.cut(runs.select(*RUN, F.col("top.component").alias("top"), outside.alias("outside"), inside.alias("inside")))
    rows = member.join(runs, RUN)
    of_top = (F.col("component") == F.col("top")) & (F.col("inside") > 0)
    rows = rows.withColumn("block", F.when(of_top, F.col("outside") + F.pmod(F.xxhash64("rep"), "inside")).otherwise(F.pmod(F.xxhash64("rep"), "outside")))
    last = F.when(of_top, F.col("outside")).otherwise(F.col("outside") + F.col("inside")) - 1
    rows = rows.withColumn("partner", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    rows = ws.cut(rows.select("rep", "component", *RUN, "block", F.least("block", "partner").alias("lo"), F.greatest("block", "partner").alias("hi")))
    tasks = max(1, rows.count() // 8000)
    rows = rows.join(coded.select("rep", "v"), "rep")
    return rows.groupBy(F.pmod(F.xxhash64(*RUN, "lo", "hi"), F.lit(tasks)).alias("task")).applyInPandas(_across(threshold), "a long, b long").distinct()


def _count(threshold: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (_, lo, hi), g in pdf.groupby(["component", "lo", "hi"], sort=False):
            v, rep, copies, block = g.v.to_numpy(), g.rep.to_numpy(), g.copies.to_numpy(), g.block.to_numpy()
            x = unit(np.stack(v))
            if lo == hi:
                close = linked(x, x, v, v, threshold)
                np.fill_diagonal(close, False)
                out.append((rep, close @ copies))
            else:
                one, two = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
                close = linked(x[one], x[two], v[one], v[two], threshold)
                out += [(rep[one], close @ copies[two]), (rep[two], close.T @ copies[one])]
        return pd.DataFrame({"rep": np.concatenate([r for r, _ in out]), "n": np.concatenate([n for _, n in out])})

    return run


def _label(vectors: DataFrame) -> Column:
    label = vectors["label"]
    if vectors.schema["label"].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint"):
        return label.cast("long")
    return F.when(label.isNotNull(), F.xxhash64(label))


def near_duplicates(vectors: DataFrame, ws: Workspace, threshold: float = THRESHOLD, passes: int = PASSES, bits: int = BITS, window: int = WINDOW, block: int = BLOCK, seed: int = 7) -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row for each row of `vectors` (vec_id, embedding, label).

    Vectors of equal label (not null) link if their cosine is `threshold` or more.
    Vectors that are null, empty, zero or hold null or non-finite values, and null
    vec_ids, link with nothing. Rows of one vec_id and vector count as copies. Labels are
    compared in their own type; those that aren't whole numbers go by a 64-bit hash.
    """
    kind = "float" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "double"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), _label(vectors).alias("label"), F.col("embedding").cast(f"array<{kind}>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    usable = F.coalesce(finite, F.lit(False)) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    keyed = rows.select("vec_id", "label", F.when(usable, F.xxhash64("v")).alias("k1"), F.when(usable, F.hash("v")).alias("k2"), "v")
    classes = ws.cut(keyed.where("k1 is not null").groupBy("label", "k1", "k2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.min("v").alias("v")))
    coded = ws.cut(classes.select("rep", "label", "v").mapInArrow(_codes(passes, bits, seed), f"rep long, label long, v array<{kind}>, dim int, codes array<long>"))
    order = ["pass", "label", "code", "rep"]
    passed = coded.select(F.posexplode("codes").alias("pass", "code"), "label", "rep", "v")
    forest = passed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_neighbours(window, threshold), "a long, b long")
    found = ws.cut(components(forest, ws))
    more = ws.cut(across_components(coded, found, ws, threshold, bits, window, block))
    if not more.isEmpty():
        wider = components(more, ws).select(F.col("node").alias("name"), F.col("component").alias("wider"))
        named = classes.select(F.col("rep").alias("node")).join(found, "node", "left").withColumn("name", F.coalesce("component", "node")).join(wider, "name", "left")
        found = ws.cut(named.where("component is not null or wider is not null").select("node", F.coalesce("wider", "component").alias("component")))

    members = ws.cut(classes.select("rep", "copies", "v").join(found.withColumnRenamed("node", "rep"), "rep"))
    n = F.count("*")
    sizes = ws.cut(members.groupBy("component").agg(F.ceil(n / block_size(n, block)).cast("long").alias("blocks")))
    placed = members.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("rep"), "blocks"))
    placed = placed.withColumn("partner", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    placed = ws.cut(placed.select("component", "rep", "copies", "v", "block", F.least("block", "partner").alias("lo"), F.greatest("block", "partner").alias("hi")))
    tasks = max(1, placed.count() // 2000)
    linked = placed.groupBy(F.pmod(F.xxhash64("component", "lo", "hi"), F.lit(tasks)).alias("task")).applyInPandas(_count(threshold), "rep long, n long").groupBy("rep").agg(F.sum("n").alias("n"))
    joined = classes.select("label", "k1", "k2", "rep", "copies").join(linked, "rep", "left").join(found.withColumnRenamed("node", "rep"), "rep", "left")
    joined = ws.cut(joined.select("label", "k1", "k2", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n"), F.coalesce("component", "rep").alias("component")))
    out = keyed.select("vec_id", "label", "k1", "k2").join(joined, ["label", "k1", "k2"], "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))
