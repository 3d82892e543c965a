"""Mixing sources to target weights by iterative proportional fitting.

The token mass of every cell (source, language, topic) is raked until its sums over
sources, languages and topics agree with target shares: given ones, or the corpus's own
shares to a power. No cell gets more than it has: a raked share is cut where its
documents would need a probability over 1, and what is cut goes to the other cells of
its categories in the next steps. A document is then kept with the probability that its
cell's raked share calls for, by a hash of its doc_id.

Only cells, one row each, are iterated: every step is written to the shared folder,
sums are pre-aggregated, and factors are joined back by key. Raking ends when no
marginal is off by more than `TOLERANCE`, or after `SWEEPS`; targets that can't be met,
as a category has too few tokens, are then met as far as they can be, which
`marginals` reports.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Workspace

#: Target share of a category: its share of tokens to this power, normalised. Under 1 flattens, 1 keeps, 0 equalises.
POWERS = {"source": 0.5, "lang": 0.7, "topic": 1.0}
SWEEPS, TOLERANCE = 12, 1e-12
#: Sweeps between two looks at the marginals.
LOOK = 3
#: Tokens to keep of all.
FRACTION = 0.5
#: Topic: the first rule whose pattern the text holds; else prose.
TOPICS = (("table", " | "), ("markup", "***"), ("shout", "!! "), ("notice", "icensed under"))
NONE = "(none)"


def topic(text: Column) -> Column:
    rules = F.when(text.contains(TOPICS[0][1]), TOPICS[0][0])
    for name, pattern in TOPICS[1:]:
        rules = rules.when(text.contains(pattern), name)
    return rules.otherwise("prose")


def tokens(text: Column) -> Column:
    """Words between spaces, tabs and line ends."""
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\t\\n\\r]+")), F.lit(0)).cast("long")


KEYS = ("source", "lang", "topic")
RESULTS = (*(f"__{k}" for k in KEYS), "__tokens", "__probability", "__sampled")


def with_cells(docs: DataFrame, topic_of: Column | None = None) -> DataFrame:
    """`docs` in a column __row, with __source, __lang, __topic (null is a category of its own) and __tokens.

    topic_of: a text column of `docs` that names the topic; the rules of `topic` otherwise.
    """
    text = F.col("text").cast("string")
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(NONE)).alias(f"__{c}")
    about = F.coalesce(topic(text), F.lit("prose")) if topic_of is None else F.coalesce(topic_of.cast("string"), F.lit(NONE))
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__row"), name("source"), name("lang"), about.alias("__topic"), tokens(text).alias("__tokens"), F.col("doc_id").alias("__doc_id"))


def targets(cells: DataFrame, key: str, power: float, given: dict[str, float] | None = None) -> DataFrame:
    """(key, target) of the categories of `key` that have tokens; targets sum to 1.

    given: weights by category, `NONE` for null; a category without one gets none.
    """
    sums = cells.groupBy(key).agg(F.sum("mass").alias("mass")).where("mass > 0")
    if given is None:
        sums = sums.select(key, F.pow("mass", F.lit(power)).alias("weight"))
    else:
        weights = cells.sparkSession.createDataFrame([(k, float(v)) for k, v in given.items()], f"{key} string, weight double")
        sums = sums.join(weights, key, "left").select(key, F.coalesce("weight", F.lit(0.0)).alias("weight"))
    total = sums.agg(F.sum("weight").alias("total"))
    return sums.join(F.broadcast(total)).select(key, F.try_divide("weight", "total").alias("target"))  # total is one row


def marginals(fitted: DataFrame, wanted: dict[str, DataFrame]) -> DataFrame:
    """(key, category, share, target) of raked cells."""
    every = None
    for k in KEYS:
        one = fitted.groupBy(k).agg(F.sum("share").alias("share")).join(wanted[k], k).select(F.lit(k).alias("key"), F.col(k).alias("category"), "share", "target")
        every = one if every is None else every.union(one)
    return every


def rake(cells: DataFrame, ws: Workspace, powers: dict[str, float] = POWERS, sweeps: int = SWEEPS, fraction: float = FRACTION, given: dict[str, dict[str, float]] | None = None, tolerance: float = TOLERANCE) -> tuple[DataFrame, dict[str, DataFrame]]:
    """`cells` (source, lang, topic, mass) with share, and the targets by key.

    Shares are raked weights that sum to 1 if the targets can be met, and cut at the
    share of a cell all of whose tokens are kept. Each sweep fits sources, then
    languages, then topics. Cells without mass keep none.
    """
    cells = ws.cut(cells.where("mass > 0"))
    total = cells.agg(F.coalesce(F.sum("mass"), F.lit(0))).first()[0]
    wanted = {k: ws.cut(targets(cells, k, powers[k], (given or {}).get(k))) for k in KEYS}
    most = F.col("mass") / (fraction * total) if fraction > 0 and total else F.lit(float("inf"))
    fitted = ws.cut(cells.select(*KEYS, "mass", F.col("mass").cast("double").alias("share")))
    for n in range(1, sweeps + 1):
        for k in KEYS:  # each step is written, so that plans stay small
            sums = fitted.groupBy(k).agg(F.sum("share").alias("__sum")).join(wanted[k], k).select(k, F.when(F.col("__sum") > 0, F.col("target") / F.col("__sum")).otherwise(0.0).alias("__factor"))
            now = ws.cut(fitted.join(sums, k).select(*KEYS, "mass", F.least(F.col("share") * F.col("__factor"), most).alias("share")))
            ws.discard(fitted)
            fitted = now
        if n % LOOK == 0 and n < sweeps:
            off = marginals(fitted, wanted).agg(F.max(F.abs(F.col("share") - F.col("target")))).first()[0]
            if off is None or off <= tolerance:
                break
    return fitted, wanted


def draw(doc_id: Column) -> Column:
    """A number from 0 to 1 for each doc_id: the first 8 hexadecimal digits of its md5."""
    return F.conv(F.substring(F.md5(doc_id.cast("string")), 1, 8), 16, 10).cast("double") / 4294967296.0


def mix(docs: DataFrame, ws: Workspace, powers: dict[str, float] = POWERS, sweeps: int = SWEEPS, fraction: float = FRACTION, given: dict[str, dict[str, float]] | None = None, topic_of: Column | None = None) -> DataFrame:
    """`docs` (doc_id, text, source, lang and others) with __source, __lang, __topic, __tokens, __probability and __sampled.

    probability = fraction * share / share of the corpus's tokens, of the document's
    cell, rounded to 6 places. given: target weights of categories by key ("source",
    "lang", "topic"); keys without them use `powers`. Documents without tokens (null
    and empty texts) and null doc_ids have probability 0. Equal doc_ids are drawn alike.
    Columns of `docs` that have a result's name are replaced.
    """
    marked = with_cells(docs, topic_of)
    cells = marked.groupBy(*(F.col(f"__{k}").alias(k) for k in KEYS)).agg(F.sum("__tokens").alias("mass"))
    fitted, _ = rake(cells, ws, powers, sweeps, fraction, given)
    total = fitted.agg(F.sum("mass").alias("total"))
    rates = fitted.join(F.broadcast(total)).select(*(F.col(k).alias(f"__{k}") for k in KEYS), F.round(F.least(F.lit(1.0), F.lit(fraction) * F.col("share") * F.col("total") / F.col("mass")), 6).alias("__rate"))  # total is one row
    rates = ws.cut(rates)
    out = marked.join(rates, [f"__{k}" for k in KEYS], "left")
    p = F.when((F.col("__tokens") > 0) & F.col("__doc_id").isNotNull(), F.coalesce("__rate", F.lit(0.0))).otherwise(0.0)
    out = out.withColumn("__probability", p).withColumn("__sampled", F.coalesce(draw(F.col("__doc_id")) < F.col("__probability"), F.lit(False)))
    return out.select(*(F.col("__row")[c].alias(c) for c in docs.columns if c not in RESULTS), *RESULTS)


def oracle_sql(powers: dict[str, float] = POWERS, sweeps: int = SWEEPS, fraction: float = FRACTION) -> str:
    """DuckDB SQL for doc_id, source, lang, topic, n_tokens, probability and sampled of `mix` over documents."""
    rules = " ".join(f"when contains(text, '{p}') then '{n}'" for n, p in TOPICS)
    parts = [
        f"d as materialized (select doc_id, coalesce(source, '{NONE}') source, coalesce(lang, '{NONE}') lang, case {rules} else 'prose' end topic, coalesce(len(regexp_extract_all(text, '[^ \\t\\n\\r]+')), 0)::bigint n_tokens from documents)",
        "c as materialized (select source, lang, topic, sum(n_tokens)::double mass from d group by all having sum(n_tokens) > 0)",
        f"s0 as materialized (select *, mass share, mass / ({fraction} * (sum(mass) over ())) most from c)",
    ]
    for k in KEYS:
        parts.append(f"t_{k} as materialized (select {k}, pow(m, {powers[k]}) / sum(pow(m, {powers[k]})) over () target from (select {k}, sum(mass) m from c group by 1))")
    n = 0
    for _ in range(sweeps):
        for k in KEYS:
            parts.append(f"s{n + 1} as materialized (select source, lang, topic, mass, most, least(share * (target / sum(share) over (partition by {k})), most) share from s{n} join t_{k} using ({k}))")
            n += 1
    return (
        "with " + ",\n".join(parts) + f"\n, r as (select source, lang, topic, round(least(1.0, {fraction} * share * (select sum(mass) from c) / mass), 6) rate from s{n})"
        " select doc_id, source, lang, topic, n_tokens, p as probability, coalesce(('0x' || substr(md5(doc_id::varchar), 1, 8))::bigint / 4294967296.0 < p, false) as sampled"
        " from (select d.*, case when n_tokens > 0 and doc_id is not null then coalesce(rate, 0.0) else 0.0 end p from d left join r using (source, lang, topic))"
    )
