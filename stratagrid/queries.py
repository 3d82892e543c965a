"""A query for each operator over the test tables, with the same query in DuckDB's SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import raster, scalar
from .operators import align, checks, segments, series, spatial, stats
from .plans import grid, ingest, layout, spec, structure
from .sources import index_files, ranged, store
from .streaming import updates

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql.strip()
        return f

    return add


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def seconds(c: str) -> Column:
    return F.floor(F.unix_timestamp(F.col(c).cast("timestamp")))


def cents(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("long")


def hourly(spark: SparkSession, d: str) -> DataFrame:
    """(user_id, sec, acc): hourly sums of events in cents, running since the last midnight (exclusive)."""
    h = read(spark, d, "events").groupBy("user_id", scalar.floor_to(seconds("ts"), 3600).alias("sec")).agg(F.sum(cents("value")).alias("cents"))
    w = Window.partitionBy("user_id", F.floor((F.col("sec") - 1) / 86400)).orderBy("sec")
    return h.select("user_id", "sec", F.sum("cents").over(w).alias("acc"))


HOURLY = """h as (select user_id, (floor(epoch(ts))::bigint // 3600) * 3600 as sec, sum(round(value * 100)::bigint)::bigint as cents from events group by 1, 2),
a as (select user_id, sec, (sum(cents) over (partition by user_id, (sec - 1) // 86400 order by sec))::bigint as acc from h)"""


CLAMPED = "case when raw < 0 and raw > -0.00007 then 0.0 when raw <= -0.00007 then null else raw end"


@query(f"""with {HOURLY}, p as (select *, lag(sec) over w ps, lag(acc) over w pa from a window w as (partition by user_id order by sec)),
r as (select user_id, sec, (acc - case when ps % 86400 = 0 then 0 else pa end)::double / (sec - ps) raw from p) select user_id, sec, {CLAMPED} as rate from r""")
def deacc_accumulated(spark: SparkSession, d: str) -> DataFrame:
    return series.deaccumulate(hourly(spark, d), ["user_id"], "sec", "acc", reset=86400).select("user_id", "sec", "rate")


@query(f"""with {HOURLY}, b as (select *, row_number() over (partition by user_id order by sec) = 1 or (sec // 3600) % 5 <> 2 as live from a),
p as (select *, lag(sec) over w ps, lag(acc) over w pa from b window w as (partition by user_id, live order by sec)),
r as (select user_id, sec, live, acc, (acc - case when ps % 86400 = 0 then 0 else pa end)::double / (sec - ps) raw from p) select user_id, sec, case when not live then acc::double else {CLAMPED} end as rate from r""")
def deacc_skip_steps(spark: SparkSession, d: str) -> DataFrame:
    df = hourly(spark, d).withColumn("skip", F.floor(F.col("sec") / 3600) % 5 == 2)
    return series.deaccumulate(df, ["user_id"], "sec", "acc", reset=86400, skip="skip").select("user_id", "sec", "rate")


@query(f"""with {HOURLY}, b as (select user_id, sec, acc::double / ((sec - 1) % 86400 + 1) m from a),
p as (select *, lag(sec) over w ps, lag(m) over w pm from b window w as (partition by user_id order by sec)),
r as (select user_id, sec, case when ps is null then null else m + (m - case when ps % 86400 = 0 then 0.0 else pm end) * (ps % 86400)::double / (sec - ps) end raw from p)
select user_id, sec, case when raw < 0 and raw > -0.00007 then 0.0 when raw <= -0.00007 then null else raw end as rate from r""")
def deacc_running_mean(spark: SparkSession, d: str) -> DataFrame:
    df = hourly(spark, d).withColumn("m", F.col("acc").cast("double") / ((F.col("sec") - 1) % 86400 + 1))
    return series.deaccumulate(df, ["user_id"], "sec", "m", reset=86400, mode="running_mean").select("user_id", "sec", "rate")


@query(f"""with {HOURLY}, b as (select user_id, sec, acc - (sec // 3600) % 7 * 50 v from a),
p as (select *, lag(sec) over w ps, lag(v) over w pv from b window w as (partition by user_id order by sec))
select user_id, sec, (v - pv)::double / (sec - ps) as rate from p""")
def deacc_signed(spark: SparkSession, d: str) -> DataFrame:
    df = hourly(spark, d).withColumn("v", F.col("acc") - F.floor(F.col("sec") / 3600) % 7 * 50)
    return series.deaccumulate(df, ["user_id"], "sec", "v", mode="signed").select("user_id", "sec", "rate")


@query(f"""with {HOURLY}, b as (select user_id, sec, acc - case (sec // 3600) % 11 when 3 then 20 when 7 then 5000 else 0 end v from a),
p as (select *, lag(sec) over w ps, lag(v) over w pv from b window w as (partition by user_id order by sec)),
r as (select user_id, (v - case when ps % 86400 = 0 then 0 else pv end)::double / (sec - ps) raw from p)
select user_id, count(*) n, count(*) filter (raw < 0 and raw > -0.01) n_clamped, count(*) filter (raw <= -0.01) n_invalid,
count(*) filter (raw <= -0.01) > 0 or count(*) filter (raw < 0 and raw > -0.01)::double / count(*) > 0.05 failed from r group by 1""")
def deacc_clamp_invalid(spark: SparkSession, d: str) -> DataFrame:
    k = F.floor(F.col("sec") / 3600) % 11
    df = hourly(spark, d).withColumn("v", F.col("acc") - F.when(k == 3, 20).when(k == 7, 5000).otherwise(0))
    return series.deaccumulation_faults(series.deaccumulate(df, ["user_id"], "sec", "v", reset=86400, clamp=-0.01), ["user_id"])


@query("""with q as (select l_returnflag, epoch(l_shipdate)::bigint // 86400 as day, sum(l_quantity) qty from lineitem group by 1, 2),
p as (select *, lag(qty) over w a, lead(qty) over w b, row_number() over w i, count(*) over (partition by l_returnflag) n from q window w as (partition by l_returnflag order by day))
select l_returnflag, day, case when day % 5 = 2 and i > 1 and i < n then (a + b) / 2 else qty end as filled from p""")
def interp_midpoint(spark: SparkSession, d: str) -> DataFrame:
    q = read(spark, d, "lineitem").groupBy("l_returnflag", F.floor(seconds("l_shipdate") / 86400).alias("day")).agg(F.sum("l_quantity").alias("qty"))
    return series.interpolate_flagged(q.withColumn("flag", F.col("day") % 5 == 2), ["l_returnflag"], "day", "qty", "flag").select("l_returnflag", "day", "filled")


DAILY = """days as (select unnest(range(0, (select (max(floor(epoch(ts))::bigint) - min(floor(epoch(ts))::bigint // 86400 * 86400)) // 86400 + 1 from events))) as day),
types as (select distinct event_type from events),
sums as (select event_type, floor(epoch(ts))::bigint // 86400 - (select min(floor(epoch(ts))::bigint) // 86400 from events) as day, sum(round(value * 100)::bigint)::bigint cents, count(*) n from events group by 1, 2),
g as (select event_type, day, coalesce(cents, 0)::bigint cents, coalesce(n, 0)::bigint n from types cross join days left join sums using (event_type, day))"""


def daily(spark: SparkSession, d: str) -> DataFrame:
    """(event_type, day, cents, n): a dense grid of event types and days."""
    e = read(spark, d, "events").select("event_type", F.floor(seconds("ts") / 86400).alias("day"), cents("value").alias("cents"))
    ends = e.agg(F.min("day").alias("lo"), F.max("day").alias("hi")).first()
    days = spark.range(ends.hi - ends.lo + 1).select(F.col("id").alias("day"))
    sums = e.groupBy("event_type", (F.col("day") - ends.lo).alias("day")).agg(F.sum("cents").alias("cents"), F.count("*").alias("n"))
    g = grid.product(e.select("event_type").distinct(), days).join(sums, ["event_type", "day"], "left")
    return g.select("event_type", "day", F.coalesce("cents", F.lit(0)).alias("cents"), F.coalesce("n", F.lit(0)).alias("n"))


@query(f"""with {DAILY}, t as (select *, sum(cents) over (partition by event_type order by day)::bigint acc from g)
select event_type, day, (acc - lag(acc) over (partition by event_type order by day))::double / 86400 as rate from t""")
def halo_region(spark: SparkSession, d: str) -> DataFrame:
    g = daily(spark, d).withColumn("acc", F.sum("cents").over(Window.partitionBy("event_type").orderBy("day"))).withColumn("sec", F.col("day") * 86400)
    parts = segments.with_halo(g, ["event_type"], "day", 7)
    return segments.trim_halo(series.deaccumulate(parts, ["event_type", "region"], "sec", "acc")).select("event_type", "day", "rate")


@query(f"""with t as (select floor(epoch(ts))::bigint // 3600 * 3600 as sec, sum(round(value * 100)::bigint)::bigint as cents from events where user_id % 3 = 1 group by 1),
a as (select sec, (sum(cents) over (partition by (sec - 1) // 86400 order by sec))::bigint as acc from t where sec // 3600 % 11 not between 4 and 6),
b as (select *, row_number() over (order by sec) = 1 or sec // 3600 % 24 not in (23, 0) as live from a),
p as (select *, lag(sec) over w ps, lag(acc) over w pa from b window w as (partition by live order by sec)),
r as (select sec, live, acc, (acc - case when ps % 21600 = 0 then 0 else pa end)::double / (sec - ps) raw from p) select sec, case when not live then acc::double else {CLAMPED} end as rate from r""")
def segmented_rates(spark: SparkSession, d: str) -> DataFrame:
    """One series without keys, with missing and skipped hours at the borders of its regions of a day, and resets there."""
    e = read(spark, d, "events").where("user_id % 3 = 1")
    t = e.groupBy(scalar.floor_to(seconds("ts"), 3600).alias("sec")).agg(F.sum(cents("value")).alias("cents")).where("sec div 3600 % 11 not between 4 and 6")
    acc = F.sum("cents").over(Window.partitionBy(F.floor((F.col("sec") - 1) / 86400)).orderBy("sec"))
    df = t.select("sec", acc.alias("acc")).withColumn("skip", F.expr("sec div 3600 % 24 in (23, 0)"))
    return series.deaccumulate(df, [], "sec", "acc", reset=21600, skip="skip", region=F.floor(F.col("sec") / 86400)).select("sec", "rate")


@query("""with x as (select l_orderkey, l_linenumber, l_partkey, l_extendedprice::float::double v from lineitem),
e as (select *, floor(log2(v)) f from x), c as (select *, case when pow(2, f) > v then f - 1 when pow(2, f + 1) <= v then f + 1 else f end e from e)
select l_orderkey, l_linenumber, l_partkey, (round_even(v / pow(2, e - 7), 0) * pow(2, e - 7))::float::double as rounded from c""")
def round_mantissa_k7(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", scalar.round_mantissa("l_extendedprice", 7).cast("double").alias("rounded"))


@query("""select l_returnflag, count(case when l_discount::float <> 0.05::float then l_discount end) kept, count(*) n, sum(case when l_discount::float <> 0.05::float then round(l_discount * 100)::bigint end)::bigint total from lineitem group by 1""")
def sentinel_mask(spark: SparkSession, d: str) -> DataFrame:
    masked = read(spark, d, "lineitem").withColumn("v", scalar.mask_sentinel("l_discount", 0.05))
    return masked.groupBy("l_returnflag").agg(F.count("v").alias("kept"), F.count("*").alias("n"), F.sum(cents("v")).alias("total"))


@query("""select event_type, count(case when (event_id & 21) = 0 then value end) any_kept, count(case when (event_id & 12) = 4 and event_id <> 4 then value end) exact_kept from events group by 1""")
def quality_masks(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events")
    return e.groupBy("event_type").agg(F.count(scalar.mask_any_bit("value", "event_id", 21)).alias("any_kept"), F.count(scalar.mask_unless_bits("value", "event_id", 12, 4, fill=4)).alias("exact_kept"))


@query("""select o_orderkey, o_totalprice * case when o_orderdate < timestamp '1996-01-01' then 1.0 when o_orderdate < timestamp '1998-01-01' then 0.5 else 2.0 end as scaled from orders""")
def scale_by_range(spark: SparkSession, d: str) -> DataFrame:
    eras = spark.createDataFrame([(None, "1996-01-01", 1.0), ("1996-01-01", "1998-01-01", 0.5), ("1998-01-01", None, 2.0)], "start string, stop string, factor double")
    eras = F.broadcast(eras.select(F.col("start").cast("timestamp_ntz").alias("start"), F.col("stop").cast("timestamp_ntz").alias("stop"), "factor"))  # three rows
    o = align.range_join(read(spark, d, "orders").withColumn("at", F.col("o_orderdate").cast("timestamp_ntz")), eras, "at", "start", "stop")
    return o.select("o_orderkey", (F.col("o_totalprice") * F.col("factor")).alias("scaled"))


@query("""select user_id, count(*) n, count(*) filter (event_type = 'error') n_missing, count(*) filter (event_type = 'error')::double / count(*) fraction from events group by 1""")
def null_fraction_by_user(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events").withColumn("v", F.when(F.col("event_type") != "error", F.col("value")))
    return stats.null_fraction(e, ["user_id"], "v")


@query("""with f as (select floor(epoch(ts))::bigint // 86400 as day, count(*) filter (event_type = 'error')::double / count(*) fraction from events group by 1),
r as (select *, row_number() over (order by day desc) as rank from f)
select day, fraction, rank, [1.0, 0.3, 0.25, 0.2][least(rank, 4)]::double as "limit" from r where rank <= 10""")
def recent_missing_tiers(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events").select(F.floor(seconds("ts") / 86400).alias("day"), F.when(F.col("event_type") != "error", F.col("value")).alias("v"))
    newest = grid.newest(stats.null_fraction(e, ["day"], "v"), "day", 10)
    return series.recency_tier(newest, "day", [1.0, 0.3, 0.25, 0.2]).select("day", "fraction", "rank", "limit")


COMPLETE = """e as (select distinct user_id, floor(epoch(ts))::bigint // 86400 as day from events),
x as (select u.user_id, d.day from (select distinct user_id from e) u cross join (select distinct day from e) d),
c as (select x.day, count(*) n_expected, count(*) filter (e.user_id is null) n_missing from x left join e using (user_id, day) group by 1)"""


def _completeness(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events").select("user_id", F.floor(seconds("ts") / 86400).alias("day"))
    return stats.completeness_of_product(e, e, e, "day", "user_id")


@query(f"with {COMPLETE} select day, n_expected, n_missing, (n_expected - n_missing)::double / n_expected as ratio from c")
def completeness_by_day(spark: SparkSession, d: str) -> DataFrame:
    return _completeness(spark, d)


@query(f"with {COMPLETE} select count(*) n_positions, count(*) filter (n_missing = 0) n_complete, min(day) filter (n_missing > 0) first_incomplete, max(day) filter (n_missing > 0) last_incomplete from c")
def completeness_summary(spark: SparkSession, d: str) -> DataFrame:
    return stats.completeness_summary(_completeness(spark, d), "day")


@query("""with m as (select max(floor(epoch(ts))::bigint // 3600 * 3600) last, count(*) n from (select distinct floor(epoch(ts))::bigint // 3600 * 3600 as t, to_timestamp(floor(epoch(ts))::bigint // 3600 * 3600)::timestamp ts from events))
select 'current_data' as "check", last = last as passed, 'newest ' || last || ' due ' || last as message, n as checked from m""")
def current_data_due(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events").select(scalar.floor_to(seconds("ts"), 3600).alias("t")).distinct()
    ends = e.agg(F.min("t").alias("lo"), F.max("t").alias("hi")).first()
    return checks.current_data(e, "t", ends.lo, 3600, 7200, ends.hi + 7200 + 1799)


@query("""select x.bucket, x.day from (select a.bucket, b.day from (select distinct user_id % 16 as bucket from events) a cross join (select distinct floor(epoch(ts))::bigint // 3600 as day from events) b
except select user_id % 16, floor(epoch(ts))::bigint // 3600 from events where event_type = 'purchase') x""")
def missing_shards(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events").select((F.col("user_id") % 16).alias("bucket"), F.floor(seconds("ts") / 3600).alias("day"), "event_type")
    expected = grid.product(e.select("bucket").distinct(), e.select("day").distinct())
    return align.missing(expected, e.where("event_type = 'purchase'"), ["bucket", "day"])


@query("""with c as (select o_orderkey, case when o_orderkey % 97 = 5 then 'X' else o_orderstatus end o_orderstatus from orders where o_orderkey % 101 <> 7)
select *, 'primary' as side from (select o_orderkey, o_orderstatus from orders except all select * from c) union all
select *, 'replica' from (select * from c except all select o_orderkey, o_orderstatus from orders)""")
def replica_diff(spark: SparkSession, d: str) -> DataFrame:
    a = read(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    b = a.where("o_orderkey % 101 <> 7").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 97 == 5, "X").otherwise(F.col("o_orderstatus")))
    return align.differences_by_digest(a, b, ["o_orderkey"], F.floor(F.col("o_orderkey") / 1000))


@query("""with x as (select o_orderkey l_orderkey, unnest([1, 2, 3, 4]) l_linenumber from orders), n as (select l_orderkey, l_linenumber, count(*) n from lineitem group by 1, 2)
select l_orderkey, l_linenumber, fault from (select coalesce(x.l_orderkey, n.l_orderkey) l_orderkey, coalesce(x.l_linenumber, n.l_linenumber) l_linenumber,
case when n.n is null then 'missing' when x.l_orderkey is null then 'unexpected' when n.n > 1 then 'duplicate' end fault
from x full join n on x.l_orderkey = n.l_orderkey and x.l_linenumber = n.l_linenumber) where fault is not null""")
def inventory_check(spark: SparkSession, d: str) -> DataFrame:
    lines = spark.range(1, 5).select(F.col("id").cast("int").alias("l_linenumber"))
    expected = grid.product(read(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey")), lines)
    return stats.inventory(expected, read(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("select c_custkey from customer where not exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'P')")
def already_present(spark: SparkSession, d: str) -> DataFrame:
    done = read(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return align.missing(read(spark, d, "customer").select("c_custkey"), done, ["c_custkey"])


@query("""select o_orderkey from orders where exists (select 1 from lineitem where l_orderkey = o_orderkey and l_returnflag = 'R') and exists (select 1 from lineitem where l_orderkey = o_orderkey and l_discount > 0.08)""")
def listed_and_indexed(spark: SparkSession, d: str) -> DataFrame:
    l = read(spark, d, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    return align.present(read(spark, d, "orders").select("o_orderkey"), l.where("l_returnflag = 'R'"), l.where("l_discount > 0.08"), keys=["o_orderkey"])


@query("""with e as (select event_id, user_id, floor(epoch(ts))::bigint t from events where event_type = 'error'), p as (select event_id, user_id, floor(epoch(ts))::bigint t from events where event_type = 'purchase'),
r as (select e.event_id, p.event_id as purchase_id, p.t - e.t as gap, row_number() over (partition by e.event_id order by abs(p.t - e.t), p.t desc, p.event_id) i from e left join p using (user_id))
select event_id, purchase_id, gap from r where i = 1""")
def asof_nearest(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events").select("event_id", "user_id", "event_type", seconds("ts").alias("t"))
    p = e.where("event_type = 'purchase'").select("user_id", F.col("t").alias("pt"), F.col("event_id").alias("purchase_id"), F.col("t").alias("found"))
    near = align.nearest(e.where("event_type = 'error'").select("event_id", "user_id", "t"), p, ["user_id"], "t", "pt", ["purchase_id", "found"])
    return near.select("event_id", "purchase_id", (F.col("found") - F.col("t")).alias("gap"))


@query("""select p_partkey, case when p_size < 10 then 5 when p_size < 23 then 15 when p_size < 38 then 30 else 45 end::double as level from part""")
def nearest_level(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "part").select("p_partkey", align.nearest_level(F.col("p_size").cast("double"), [5.0, 15.0, 30.0, 45.0]).alias("level")).withColumn("level", F.col("level") + 0.0)


@query("""select p_partkey, greatest(0, least(19, ceil((p_retailprice - 900.0) / 10.0 - 0.5)))::bigint as cell from part""")
def nearest_cell(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "part").select("p_partkey", align.nearest_cell(F.col("p_retailprice"), 900.0, 10.0, 20).alias("cell"))


@query("""with s as (select o_custkey, epoch(min(o_orderdate))::bigint // 86400 a, epoch(max(o_orderdate))::bigint // 86400 b from orders group by 1), x as (select o_custkey, greatest(a, 9500) lo, least(b, 10200) hi from s)
select o_custkey, case when lo <= hi then lo end lo, case when lo <= hi then hi end hi from x""")
def range_overlap(spark: SparkSession, d: str) -> DataFrame:
    s = read(spark, d, "orders").groupBy("o_custkey").agg(F.floor(F.min(seconds("o_orderdate")) / 86400).alias("a"), F.floor(F.max(seconds("o_orderdate")) / 86400).alias("b"))
    lo, hi = align.overlap(F.col("a"), F.col("b"), F.lit(9500), F.lit(10200))
    return s.select("o_custkey", lo.alias("lo"), hi.alias("hi"))


@query("""with a as (select n_name, row_number() over (order by n_nationkey) - 1 as position from nation), l as (select n_name from nation union all select 'NOWHERE')
select n_name, coalesce(position, -1)::bigint as position, position // 4 as chunk, coalesce(position % 4 = 0, false) on_boundary from l left join a using (n_name)""")
def chunk_key(spark: SparkSession, d: str) -> DataFrame:
    n = read(spark, d, "nation")
    labels = n.select("n_name").union(spark.createDataFrame([("NOWHERE",)], "n_name string"))
    return align.labels_to_chunks(labels, n.select("n_name", F.col("n_nationkey").cast("long").alias("position")), "n_name", 4)


@query("""with v(var, p_type) as (values ('t2m', 'ECONOMY'), ('t2m_max', 'ECONOMY'), ('rh', 'STANDARD'), ('u10', 'PROMO')) select p_partkey, p_type, var from part join v using (p_type)""")
def message_lookup(spark: SparkSession, d: str) -> DataFrame:
    wanted = spark.createDataFrame([("t2m", "ECONOMY"), ("t2m_max", "ECONOMY"), ("rh", "STANDARD"), ("u10", "PROMO")], "var string, p_type string")
    return index_files.lookup(read(spark, d, "part").select("p_partkey", "p_type"), F.broadcast(wanted), ["p_type"]).select("p_partkey", "p_type", "var")  # four rows


OFFSETS = "o as (select doc_id, source, n_chars, (sum(n_chars) over (partition by source order by doc_id) - n_chars)::bigint as start from documents)"


def offsets(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents").select("doc_id", "source", "n_chars")
    return segments.running_sum(docs, ["source"], "doc_id", "n_chars", F.floor(F.col("doc_id") / 4096), "end").select("doc_id", "source", "n_chars", (F.col("end") - F.col("n_chars")).alias("start"))


@query(f"with {OFFSETS} select source, doc_id, start, coalesce(lead(start) over (partition by source order by start), start + 10737418240) as stop from o where n_chars > 0")
def byte_ranges(spark: SparkSession, d: str) -> DataFrame:
    return index_files.byte_ranges(offsets(spark, d).where("n_chars > 0"), "source", "start").select("source", "doc_id", "start", "stop")


@query("""select l_orderkey, l_linenumber, l_partkey from lineitem where l_orderkey not in (select l_orderkey from lineitem where l_quantity * 100 > 4800)""")
def stale_file_guard(spark: SparkSession, d: str) -> DataFrame:
    r = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.lit(0).alias("start"), (F.col("l_quantity") * 100).alias("stop"), F.lit(4800).alias("size"))
    return index_files.drop_stale_files(r, "l_orderkey", "size").select("l_orderkey", "l_linenumber", "l_partkey")


@query("""select date_trunc('month', l_shipdate)::date::varchar as month, round(avg(l_quantity), 6) mean, round(stddev_pop(l_quantity), 6) std, count(l_quantity) n from lineitem group by 1""")
def mean_std_series(spark: SparkSession, d: str) -> DataFrame:
    l = read(spark, d, "lineitem").withColumn("month", F.trunc(F.col("l_shipdate").cast("date"), "month").cast("string"))
    return stats.mean_std(l, ["month"], "l_quantity").select("month", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "n")


@query("""select o_orderpriority, round(quantile_cont(o_totalprice, 0.5), 6) p50, round(quantile_cont(o_totalprice, 0.95), 6) p95, round(quantile_cont(o_totalprice, 0.99), 6) p99 from orders group by 1""")
def quantiles(spark: SparkSession, d: str) -> DataFrame:
    q = stats.quantiles(read(spark, d, "orders"), ["o_orderpriority"], "o_totalprice", {"p50": 0.5, "p95": 0.95, "p99": 0.99})
    return q.select("o_orderpriority", *(F.round(c, 6).alias(c) for c in ("p50", "p95", "p99")))


@query("""with s as (select min(o_totalprice) lo, max(o_totalprice) hi, count(*) total from orders)
select least(39, floor((o_totalprice - lo) / ((hi - lo) / 40)))::bigint as bin, count(*) n, round(count(*)::double / (any_value(total) * any_value((hi - lo) / 40)), 12) density from orders, s group by 1""")
def histogram40(spark: SparkSession, d: str) -> DataFrame:
    return stats.histogram(read(spark, d, "orders"), "o_totalprice").withColumn("density", F.round("density", 12))


@query(f"with {DAILY} select event_type, day * least(12, (select max(day) + 1 from g)) // (select max(day) + 1 from g) as block, avg(n)::double mean from g group by 1, 2")
def block_mean(spark: SparkSession, d: str) -> DataFrame:
    g = daily(spark, d).select("event_type", "day", F.col("n").cast("double").alias("n"))
    n = g.agg(F.max("day")).first()[0] + 1
    return stats.block_mean(g, "day", "n", n, 12, ["event_type"])


@query("""with r as (select n_nationkey, ((n_nationkey & 1) << 4) | ((n_nationkey & 2) << 2) | (n_nationkey & 4) | ((n_nationkey & 8) >> 2) | ((n_nationkey & 16) >> 4) as rev from nation)
select n_nationkey, rev::bigint as spread_key, ((row_number() over (order by rev) - 1) % 4)::bigint as worker, (n_nationkey // 7)::bigint as block_worker from r""")
def worker_assignment(spark: SparkSession, d: str) -> DataFrame:
    n = read(spark, d, "nation").select("n_nationkey")
    spread = grid.assign(n.withColumn("spread_key", grid.bit_reversal(F.col("n_nationkey"), 25)), "n_nationkey", 4)
    block = grid.assign(n, "n_nationkey", 4, "contiguous").withColumnRenamed("worker", "block_worker")
    return spread.join(block, "n_nationkey").select("n_nationkey", "spread_key", "worker", "block_worker")


@query("""with x as (select distinct epoch(o_orderdate)::bigint // 86400 as day from orders), i as (select day, row_number() over (order by day) - 1 as i, count(*) over () n from x)
select day from i where i in (select round_even(k * (n - 1)::double / 9, 0)::bigint from (select unnest(range(0, 10)) k), (select max(n) n from i))""")
def evenly_spaced(spark: SparkSession, d: str) -> DataFrame:
    days = read(spark, d, "orders").select(F.floor(seconds("o_orderdate") / 86400).alias("day")).distinct()
    n = days.count()
    wanted = grid.evenly_spaced(n, 10)
    return days.withColumn("i", F.row_number().over(Window.orderBy("day")) - 1).where(F.col("i").isin(wanted)).select("day")  # an axis, one row a day


@query("""select floor(epoch(ts))::bigint // 86400 as day, max(case when event_type = 'click' then value end) as click, max(case when event_type = 'error' then value end) as error, max(case when event_type = 'purchase' then value end) as purchase from events group by 1""")
def pivot_availability(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events").withColumn("day", F.floor(seconds("ts") / 86400))
    return align.outer_pivot(e, ["day"], "event_type", ["click", "error", "purchase"], F.col("value"))


@query("""with c as (select vec_id, unnest(embedding)::double as value, generate_subscripts(embedding, 1) - 1 as i from embeddings), s as (select vec_id, i // 8 as y, i % 8 as x, value from c),
f as (select vec_id, fy, fx from (select distinct vec_id from s), (select unnest(range(0, 15)) fy), (select unnest(range(0, 16)) fx))
select f.vec_id, fy as y, fx as x, round((a.value * (2 - fy % 2) * (2 - fx % 2) + b.value * (2 - fy % 2) * (fx % 2) + c.value * (fy % 2) * (2 - fx % 2) + e.value * (fy % 2) * (fx % 2)) / 4, 6) + 0.0 as value
from f join s a on a.vec_id = f.vec_id and a.y = fy // 2 and a.x = fx // 2 join s b on b.vec_id = f.vec_id and b.y = fy // 2 and b.x = (fx // 2 + 1) % 8
join s c on c.vec_id = f.vec_id and c.y = least(7, fy // 2 + 1) and c.x = fx // 2 join s e on e.vec_id = f.vec_id and e.y = least(7, fy // 2 + 1) and e.x = (fx // 2 + 1) % 8""")
def regrid_bilinear(spark: SparkSession, d: str) -> DataFrame:
    cells = read(spark, d, "embeddings").select("vec_id", F.posexplode("embedding").alias("i", "v"))
    cells = cells.select("vec_id", F.floor(F.col("i") / 8).alias("y"), (F.col("i") % 8).cast("long").alias("x"), F.col("v").cast("double").alias("value"))
    return raster.refine(cells, ["vec_id"], 2, 8, 8).select("vec_id", "y", "x", (F.round("value", 6) + 0.0).alias("value"))


@query("""with x as (select o_orderkey, (o_orderkey % 4) * 6 * (o_orderkey % 3) as a, (o_orderkey % 4) * 6 * (o_orderkey % 3) + (o_orderkey % 5) * 12 as b from orders)
select o_orderkey, case when a = b and b = 0 then 'anl' when a = b then b || ' hour fcst' when a = 0 and b % 24 = 0 and b > 0 then '0-' || (b // 24) || ' day acc fcst' else a || '-' || b || ' hour acc fcst' end as label from x""")
def window_label(spark: SparkSession, d: str) -> DataFrame:
    a = (F.col("o_orderkey") % 4) * 6 * (F.col("o_orderkey") % 3)
    return read(spark, d, "orders").select("o_orderkey", scalar.window_label(a, a + (F.col("o_orderkey") % 5) * 12).alias("label"))


@query("""select doc_id, lang || '/' || source || '/' || lang || '.idx' as path, lang || '/' || source as grp, lang || '.idx' as name, 'src-' || substr(source, 4) || '-' || lang as slug from documents""")
def path_functions(spark: SparkSession, d: str) -> DataFrame:
    file = F.concat(F.col("source"), F.lit("/"), F.col("lang"), F.lit(".idx"))
    df = read(spark, d, "documents").select("doc_id", "lang", "source", scalar.date_first_path(file, "lang").alias("path"))
    group, name = scalar.split_var_path("path")
    raw = F.concat(F.lit("--Src "), F.substring("source", 4, 9), F.lit("__"), F.col("lang"), F.lit("!"))
    return df.select("doc_id", "path", group.alias("grp"), name.alias("name"), scalar.slug(raw).alias("slug"))


@query("""select o_orderkey, (year(o_orderdate) + case when month(o_orderdate) >= 10 then 1 else 0 end)::int as water_year,
case when (o_orderkey * 1800) % 3600 = 0 then o_orderkey * 1800 // 3600 end::bigint as hours, printf('https://x.test/%s/%03d.nc', strftime(o_orderdate, '%Y%m%d'), o_orderkey % 400) as url from orders""")
def date_functions(spark: SparkSession, d: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    url = scalar.template_url("https://x.test/{day:s}/{lead:03d}.nc", day=F.date_format(day, "yyyyMMdd"), lead=F.col("o_orderkey") % 400)
    return read(spark, d, "orders").select("o_orderkey", scalar.water_year(F.year(day), F.month(day)).alias("water_year"), scalar.whole_hours(F.col("o_orderkey") * 1800).alias("hours"), url.alias("url"))


@query("""with e as (select event_id, floor(epoch(ts))::bigint // 60 as m from events)
select event_id, max(f)::bigint as fired from (select event_id, m, m // 1440 * 1440 + unnest([-1440 + 50, -1440 + 410, -1440 + 1130, 50, 410, 1130]) as f from e) where f <= m group by 1""")
def previous_fire(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "events").select("event_id", scalar.previous_fire(F.floor(seconds("ts") / 60), 50, [0, 6, 18]).alias("fired"))


@query("""with n as (select o_orderkey, 'file_' || strftime(o_orderdate, '%Y%m%d') || '00_' || case when o_orderkey % 3 = 0 then '1234567890_' else 'f' || o_orderkey end || '_x' as name from orders)
select o_orderkey, case when o_orderkey % 3 = 0 then null else regexp_extract(name, '_([0-9]{10})_', 1) end as init from n""")
def init_from_name(spark: SparkSession, d: str) -> DataFrame:
    day = F.date_format(F.col("o_orderdate").cast("date"), "yyyyMMdd")
    name = F.concat(F.lit("file_"), day, F.lit("00_"), F.when(F.col("o_orderkey") % 3 == 0, "1234567890_").otherwise(F.concat(F.lit("f"), F.col("o_orderkey").cast("string"))), F.lit("_x"))
    return read(spark, d, "orders").select("o_orderkey", scalar.init_from_name(name).alias("init"))


@query("""with x as (select *, split_part(regexp_replace(source, '[0-9]', '', 'g'), 'x', 1) || '/' || lang || '/' || (doc_id % 50) as name, doc_id // 50 as stamp from documents)
select name, max(stamp) as stamp, arg_max(n_chars, stamp) as n_chars from x group by 1""")
def listing_join(spark: SparkSession, d: str) -> DataFrame:
    x = read(spark, d, "documents").select(F.concat_ws("/", F.regexp_replace("source", "[0-9]", ""), "lang", (F.col("doc_id") % 50).cast("string")).alias("name"), F.floor(F.col("doc_id") / 50).alias("stamp"), "n_chars")
    return align.latest_listed(x.withColumn("at", F.col("stamp")), ["name"], "stamp", ["at", "n_chars"]).select("name", F.col("at").alias("stamp"), "n_chars")


@query("""select o_custkey, o_orderkey from (select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by case o_orderstatus when 'F' then 0 when 'O' then 1 else 2 end, o_orderkey) i from orders) where i = 1""")
def fallback_pick(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders").withColumn("p", F.struct(F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2), "o_orderkey"))
    return align.first_available(o, ["o_custkey"], "p").select("o_custkey", "o_orderkey")


@query("""with i as (select distinct floor(epoch(ts))::bigint // 21600 * 21600 as init from events), l as (select distinct l_quantity::bigint * 3600 as lead from lineitem)
select init, lead from i, l where lead <= case when init % 43200 = 0 then 172800 else 64800 end""")
def expected_leads(spark: SparkSession, d: str) -> DataFrame:
    inits = read(spark, d, "events").select(scalar.floor_to(seconds("ts"), 21600).alias("init")).distinct()
    leads = read(spark, d, "lineitem").select((F.col("l_quantity").cast("long") * 3600).alias("lead")).distinct()
    return grid.expected_leads(inits, leads, "init", "lead", F.when(F.col("init") % 43200 == 0, 172800).otherwise(64800))


@query("""select distinct lead from (select unnest(range(0, (select count(*) from customer) + 1)) as lead union all select unnest(range(0, 3 * (select count(*) from part) + 1, 3)))""")
def lead_axis(spark: SparkSession, d: str) -> DataFrame:
    n_customers, n_parts = (read(spark, d, t).count() for t in ("customer", "part"))
    return grid.lead_axis(spark, (0, n_customers, 1), (0, 3 * n_parts, 3))


@query("""with a as (select day, row_number() over (order by day) - 1 as i from (select distinct epoch(o_orderdate)::bigint // 86400 as day from orders)), r as (select i // 30 as region, min(day) least, max(day) most from a group by 1)
select region, least, most from r where most >= 9600 and least < 10000""")
def region_filter(spark: SparkSession, d: str) -> DataFrame:
    return grid.regions_between(_day_axis(spark, d), "i", "day", 30, 9600, 10000)


@query("""with a as (select day, row_number() over (order by day) - 1 as i from (select distinct epoch(o_orderdate)::bigint // 86400 as day from orders))
select distinct i // 30 as region from a where day in (9601, 9999, 9700, 123456789)""")
def region_points(spark: SparkSession, d: str) -> DataFrame:
    points = spark.createDataFrame([(9601,), (9999,), (9700,), (123456789,)], "day long")
    return grid.regions_containing(_day_axis(spark, d), "i", "day", 30, points)


def _day_axis(spark: SparkSession, d: str) -> DataFrame:
    days = read(spark, d, "orders").select(F.floor(seconds("o_orderdate") / 86400).alias("day")).distinct()
    return days.withColumn("i", F.row_number().over(Window.orderBy("day")) - 1)  # an axis, one row a day


@query("""with e as (select event_id, floor(epoch(ts))::bigint // 3600 * 3600 as v from events), i as (select event_id, v, v // 21600 * 21600 as i0 from e)
select event_id, i0 as init, v - i0 as lead, case when i0 = v then i0 - 21600 else i0 end as init_late, v - case when i0 = v then i0 - 21600 else i0 end as lead_late from i""")
def analysis_source(spark: SparkSession, d: str) -> DataFrame:
    v = scalar.floor_to(seconds("ts"), 3600)
    (i, l), (i1, l1) = grid.analysis_source(v, 21600), grid.analysis_source(v, 21600, has_hour_0=False)
    return read(spark, d, "events").select("event_id", i.alias("init"), l.alias("lead"), i1.alias("init_late"), l1.alias("lead_late"))


@query("""select p_type, p_brand, p_partkey, ((row_number() over (partition by p_type, p_brand order by p_partkey) - 1) // 6)::bigint as batch from part""")
def variable_batches(spark: SparkSession, d: str) -> DataFrame:
    return grid.batches(read(spark, d, "part").select("p_type", "p_brand", "p_partkey"), ["p_type", "p_brand"], "p_partkey", 6)


@query("""with f as (select o_custkey, epoch(o_orderdate)::bigint // 86400 // 30 as month, o_orderpriority, max(case when o_orderstatus = 'F' then 1 else 0 end) p from orders group by 1, 2, 3)
select month, o_orderpriority, sum(p)::bigint n_present, count(*) n_expected from f group by 1, 2""")
def fold_files(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders").select("o_custkey", "o_orderpriority", F.floor(seconds("o_orderdate") / 86400 / 30).alias("month"), (F.col("o_orderstatus") == "F").alias("present"))
    return stats.fold_files(o, ["month", "o_orderpriority"], "o_custkey", "present")


@query("""select c_nationkey, min(c_acctbal) least, max(c_acctbal) most, round(avg(c_acctbal), 6) mean from customer group by 1""")
def spatial_stats(spark: SparkSession, d: str) -> DataFrame:
    return stats.spatial_stats(read(spark, d, "customer"), ["c_nationkey"], "c_acctbal").withColumn("mean", F.round("mean", 6))


@query("""select o_custkey, max(case when o_orderstatus = 'F' then epoch(o_orderdate)::bigint // 86400 end) last_success from orders group by 1""")
def last_success(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders").select("o_custkey", F.floor(seconds("o_orderdate") / 86400).alias("day"), F.when(F.col("o_orderstatus") == "F", "Succeeded").otherwise("ReadFailed").alias("status"))
    return stats.last_success(o, ["o_custkey"], "day")


@query("""select o_orderpriority, 1 - (avg(case when o_orderstatus = 'P' then 1 else 0 end) + avg(case when o_orderkey % 7 = 0 then 1 else 0 end)) / 2 as availability from orders group by 1""")
def availability(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders").select("o_orderpriority", F.when(F.col("o_orderstatus") != "P", 1).alias("a"), F.when(F.col("o_orderkey") % 7 != 0, 1).alias("b"))
    return stats.availability(o, ["o_orderpriority"], "a", "b")


@query("""with n as (select c_nationkey, c_mktsegment, max(c_acctbal) as v from customer group by 1, 2)
select a.c_nationkey, a.c_mktsegment, round(avg(b.v), 6) as siblings from n a left join n b on a.c_nationkey = b.c_nationkey and a.c_mktsegment <> b.c_mktsegment group by 1, 2""")
def sibling_availability(spark: SparkSession, d: str) -> DataFrame:
    n = read(spark, d, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.max("c_acctbal").alias("v"))
    return stats.sibling_mean(n, ["c_nationkey"], "c_mktsegment", "v").withColumn("siblings", F.round("siblings", 6))


@query("""select s_suppkey, case when (v & 32768) <> 0 then -(v & 32767) else v end as number, substr(sha256(s_name || v::varchar), 1, 8) as digest from (select *, (s_suppkey * 40503) % 65536 as v from supplier)""")
def bits_and_digests(spark: SparkSession, d: str) -> DataFrame:
    s = read(spark, d, "supplier").withColumn("v", (F.col("s_suppkey") * 40503) % 65536)
    return s.select("s_suppkey", scalar.signed_magnitude("v", 16).alias("number"), scalar.digest8(F.col("s_name"), F.col("v").cast("string")).alias("digest"))


@query("""select user_id, event_id from (select user_id, min(event_id) as event_id from events group by user_id, floor(epoch(ts))::bigint // 3600)""")
def stream_refs(spark: SparkSession, d: str) -> DataFrame:
    """One reference per user and hour by micro-batches: each batch logs the minima it changed, and the log's minima don't depend on the order of files."""
    root = scratch(spark, "stream")
    source = read(spark, d, "events")
    source.repartition(4).write.parquet(f"{root}/landing")
    stream = updates.read_files(spark, f"{root}/landing", source.schema, files_per_batch=2)
    rows = stream.select("user_id", F.floor(seconds("ts") / 3600).alias("hour"), "event_id")
    least = rows.groupBy("user_id", "hour").agg(F.min("event_id").alias("event_id"))

    def commit(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/refs/batch={batch_id}")  # a batch that runs again replaces itself

    least.writeStream.outputMode("update").foreachBatch(commit).option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{root}/refs").groupBy("user_id", "hour").agg(F.min("event_id").alias("event_id")).select("user_id", "event_id")


@query()
def layout_score(spark: SparkSession, d: str) -> DataFrame:
    return layout.chunk_shapes(spark, {"time": 720, "latitude": 721, "longitude": 1440}, ("latitude", "longitude"))


@query(f"""with {HOURLY}, m as (select user_id, sec, case when acc % 100 = 99 then null else acc::double end as acc from a),
p as (select *, lag(sec) over w ps, lag(acc) over w pa from m window w as (partition by user_id order by sec)),
q as (select user_id, sec, (acc - case when ps % 86400 = 0 then 0 else pa end) / (sec - ps) as raw from p), r as (select user_id, sec, {CLAMPED} as rate from q),
x as (select *, (rate * 3600)::float::double as v from r), e as (select *, floor(log2(abs(v))) f from x),
c as (select *, case when pow(2, f) > abs(v) then f - 1 when pow(2, f + 1) <= abs(v) then f + 1 else f end e from e)
select user_id, sec, case when v = 0 then 0.0 else (round_even(v / pow(2, e - 9), 0) * pow(2, e - 9)) end::float::double as value from c""")
def ingest_pipeline(spark: SparkSession, d: str) -> DataFrame:
    """Mask, rate, scale and round, as one dataset's variable declares it."""
    cells = hourly(spark, d).withColumn("value", F.when(F.col("acc") % 100 == 99, float("nan")).otherwise(F.col("acc").cast("double")))
    v = spec.Variable("precipitation", rate="accumulated", reset=86400, factor_after=3600.0, keep_bits=9)
    return spec.transform(cells, v, ["user_id"], "sec").select("user_id", "sec", F.col("value").cast("double").alias("value"))


@query("""with a as (select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by o_orderkey) - 1 as i, o_totalprice as v from orders)
select c.c_custkey, k.i, a.v from (select c_custkey from customer) c cross join (select unnest(range(0, 6)) as i) k left join a on a.o_custkey = c.c_custkey and a.i = k.i""")
def reindex_axis(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    a = read(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), (F.row_number().over(w) - 1).cast("long").alias("i"), F.col("o_totalprice").alias("v"))
    return grid.reindex(a, spark.range(6).select(F.col("id").alias("i")), "i", read(spark, d, "customer").select("c_custkey"))


@query("""select o_orderkey, case when o_orderdate < timestamp '1997-07-01' then 'archive' else 'open' end as source,
o_orderpriority || '-' || case when o_orderkey % 51 = 0 then 'control' when o_orderkey % 51 <= 25 then 'low' else 'high' end as kind,
case when o_orderkey % 61 between 0 and 6 then 'tp_short' when o_orderkey % 61 between 4 and 30 then 'tp_mid' else 'tp' end as param from orders""")
def multi_source(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders")
    source = scalar.era(F.col("o_orderdate").cast("date"), "1997-07-01", F.lit("archive"), F.lit("open"))
    param = index_files.param_by_lead(F.col("o_orderkey") % 61, [(0, 6, "tp_short"), (4, 30, "tp_mid")], F.lit("tp"))
    return o.select("o_orderkey", source.alias("source"), grid.archive_kind(F.col("o_orderpriority"), F.col("o_orderkey") % 51).alias("kind"), param.alias("param"))


@query("""with s as (select user_id, event_type, count(*) filter (value > 95) as found from events group by 1, 2), g as (select user_id, count(*) n, count(*) filter (found > 0) n_found from s group by 1)
select user_id, n, n_found, case when n_found = n then 'published' when n_found = 0 then 'absent' else 'partial' end as state from g""")
def publication_gate(spark: SparkSession, d: str) -> DataFrame:
    s = read(spark, d, "events").groupBy("user_id", "event_type").agg(F.count_if(F.col("value") > 95).alias("found"))
    return grid.publication_state(s, "user_id", "found")


@query("""with s as (select c_nationkey, c_mktsegment, count(*)::double / 100 as fraction, max(case when c_acctbal < -990 then c_name end) as error from customer group by 1, 2)
select c_mktsegment, min(fraction) least_fraction, min(error) first_error from s group by 1""")
def worst_sample(spark: SparkSession, d: str) -> DataFrame:
    s = read(spark, d, "customer").groupBy("c_nationkey", "c_mktsegment").agg((F.count("*") / 100).alias("fraction"), F.max(F.when(F.col("c_acctbal") < -990, F.col("c_name"))).alias("error"))
    return stats.worst(s, ["c_mktsegment"], "fraction", "error")


@query("""select p_name, min(p_size) low, max(p_size) high from part group by 1 having min(p_size) <> max(p_size)""")
def group_conflicts(spark: SparkSession, d: str) -> DataFrame:
    return align.conflicts(read(spark, d, "part"), ["p_name"], "p_size")


@query("""select o_custkey, min(n) least, max(n) most from (select o_custkey, o_orderstatus, count(*) n from orders group by 1, 2) group by 1 having min(n) <> max(n)""")
def structure_sizes(spark: SparkSession, d: str) -> DataFrame:
    return stats.distinct_sizes(read(spark, d, "orders").groupBy("o_custkey", "o_orderstatus").agg(F.count("*").alias("n")), ["o_custkey"], "n")


@query("""with x as (select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by o_orderkey desc) r from orders) select o_custkey, o_orderkey from x where r > 1""")
def drop_last_step(spark: SparkSession, d: str) -> DataFrame:
    return series.drop_last_step(read(spark, d, "orders").select("o_custkey", "o_orderkey"), ["o_custkey"], "o_orderkey")


@query("""select p_partkey, round_even(p_size / 4.0::double, 1) as half_even, case when p_size <> 13 then p_size * 0.5::double + 1 end as unpacked, case p_type when 'ECONOMY' then 'eco' when 'PROMO' then 'pro' else p_type end as renamed,
case when p_partkey % 3 = 0 then p_type else p_brand || '/' || p_type end as path, printf('%.4f', p_size / 8.0::double) as text from part""")
def scalar_functions(spark: SparkSession, d: str) -> DataFrame:
    group = F.when(F.col("p_partkey") % 3 != 0, F.col("p_brand"))
    return read(spark, d, "part").select(
        "p_partkey",
        scalar.round_half_even(F.col("p_size") / 4, 1).alias("half_even"),
        scalar.unpack("p_size", 0.5, 1.0, 13).alias("unpacked"),
        scalar.rename("p_type", {"ECONOMY": "eco", "PROMO": "pro"}).alias("renamed"),
        scalar.join_var_path(group, "p_type").alias("path"),
        scalar.coordinate_text(F.col("p_size") / 8).alias("text"),
    )


@query("""select o_custkey, case when len(l) > 6 then array_to_string(l[1:3] || ['...'] || l[len(l) - 2:], ', ') else array_to_string(l, ', ') end as keys, '{"n":' || len(l) || '}' as tagged
from (select o_custkey, list(o_orderkey::varchar order by o_orderkey) l from orders group by 1)""")
def shortened_lists(spark: SparkSession, d: str) -> DataFrame:
    g = read(spark, d, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list("o_orderkey")).alias("l"))
    g = g.select("o_custkey", F.transform("l", lambda x: x.cast("string")).alias("l"))
    return g.select("o_custkey", scalar.shortened("l").alias("keys"), scalar.tagged("n", F.size("l")).alias("tagged"))


@query("""select c_custkey from (select c_custkey, row_number() over (partition by (c_custkey >= n // 2) order by md5('5:' || c_custkey::varchar), c_custkey) r from customer, (select count(*) n from customer) where c_custkey >= n // 4 and c_custkey < n - n // 4) where r <= 3""")
def central_points(spark: SparkSession, d: str) -> DataFrame:
    c = read(spark, d, "customer").select("c_custkey")
    return grid.central_points(c, "c_custkey", c.count(), seed=5, draw=3).select("c_custkey")


@query("""select c_custkey from customer where c_custkey // 40 >= 15 and c_custkey % 40 < 20 and c_custkey % 3 = 0""")
def sampled_quadrant(spark: SparkSession, d: str) -> DataFrame:
    c = read(spark, d, "customer").select("c_custkey", F.floor(F.col("c_custkey") / 40).alias("y"), (F.col("c_custkey") % 40).alias("x"))
    return grid.every_kth(grid.quadrant(c, "y", "x", 30, 40, 2), "c_custkey", 3).select("c_custkey")


@query("""select c_custkey from customer, (select min(s_acctbal) a, max(s_acctbal) b, min(s_nationkey) c, max(s_nationkey) d from supplier where s_nationkey between 4 and 9) where c_acctbal between a and b and c_nationkey between c and d""")
def bounding_box(spark: SparkSession, d: str) -> DataFrame:
    c = read(spark, d, "customer").select("c_custkey", F.col("c_acctbal").alias("lat"), F.col("c_nationkey").alias("lon"))
    s = read(spark, d, "supplier").where("s_nationkey between 4 and 9").select(F.col("s_acctbal").alias("lat"), F.col("s_nationkey").alias("lon"))
    return grid.box(c, s, "lat", "lon").select("c_custkey")


@query("""with n as (select sin(radians(38.5)) n), f as (select n, cos(radians(38.5)) * pow(tan(pi() / 4 + radians(38.5) / 2), n) / n f from n),
r as (select *, 6371229.0 * f / pow(tan(pi() / 4 + radians(38.5) / 2), n) rho0 from f),
p as (select c_custkey, (c_custkey % 50 - 25) * 30000.0 + 15000 x, (c_custkey // 50 - 15) * 30000.0 + 15000 y from customer)
select c_custkey, round(degrees(2 * atan(pow(6371229.0 * f / sqrt(x * x + pow(rho0 - y, 2)), 1 / n))) - 90, 6) as lat, round(degrees(atan2(x, rho0 - y) / n) - 97.5, 6) as lon from p, r""")
def projection_inverse(spark: SparkSession, d: str) -> DataFrame:
    x = scalar.scale(F.col("c_custkey") % 50 - 25, 30000.0, 15000)
    y = scalar.scale(F.floor(F.col("c_custkey") / 50) - 15, 30000.0, 15000)
    lat, lon = raster.lambert_inverse(x, y, 38.5, -97.5, 38.5, 38.5)
    return read(spark, d, "customer").select("c_custkey", F.round(lat, 6).alias("lat"), F.round(lon, 6).alias("lon"))


@query("""with n as (select (select count(distinct epoch(o_orderdate)::bigint // 86400) from orders) t, (select count(*) from supplier) y, (select count(*) from customer) x)
select t.t, y.y, x.x from (select unnest(range(0, (select ceil(t / 30.0)::bigint from n))) t) t, (select unnest(range(0, (select ceil(y / 25.0)::bigint from n))) y) y, (select unnest(range(0, (select ceil(x / 25.0)::bigint from n))) x) x""")
def shard_product(spark: SparkSession, d: str) -> DataFrame:
    days = read(spark, d, "orders").where("o_orderdate is not null").select(F.floor(seconds("o_orderdate") / 86400).alias("day")).distinct().count()
    shape = {"t": days, "y": read(spark, d, "supplier").count(), "x": read(spark, d, "customer").count()}
    return grid.shards_of_shape(spark, shape, {"t": 30, "y": 25, "x": 25})


@query("""with v as (select distinct p_type, p_partkey, p_size * 10000 as n_bytes from part), m as (select *, greatest(200000 // max(n_bytes) over (partition by p_type), 1) as per from v)
select p_type, p_partkey, n_bytes, ((row_number() over (partition by p_type order by p_partkey) - 1) // per)::bigint as batch from m""")
def request_shards(spark: SparkSession, d: str) -> DataFrame:
    """Variables of a request group cut so that no request is over its bytes, unless of one variable."""
    v = read(spark, d, "part").select("p_type", "p_partkey", (F.col("p_size") * 10000).alias("n_bytes"))
    return grid.batches_by_bytes(v, ["p_type"], "p_partkey", "n_bytes", 200_000)


@query("""with i as (select p_brand as file, p_partkey % 2 as kind, p_type as element, 'level ' || p_size as level, p_partkey as message from part),
w(var, kind, element, level) as (values ('t', 0, 'ECONOMY|PROMO', null), ('u', 0, 'STANDARD', 'level 1[0-9]'), ('v', 1, 'S.*', 'level 2|level 3'), ('none', 1, 'nothing', null)),
f as (select file, var, count(*) n from i join w on i.kind = w.kind and (w.element is null or regexp_full_match(i.element, w.element)) and (w.level is null or regexp_full_match(i.level, w.level)) group by 1, 2)
select file, var, coalesce(n, 0)::bigint as n from (select distinct file from i) cross join w left join f using (file, var) where coalesce(n, 0) <> 1""")
def lookup_faults(spark: SparkSession, d: str) -> DataFrame:
    """Variables that a file's index doesn't have exactly once, looked up by alternatives, patterns and any level."""
    index = read(spark, d, "part").select(F.col("p_brand").alias("file"), (F.col("p_partkey") % 2).alias("kind"), F.col("p_type").alias("element"), F.concat(F.lit("level "), F.col("p_size").cast("string")).alias("level"), F.col("p_partkey").alias("message"))
    wanted = spark.createDataFrame([("t", 0, "ECONOMY|PROMO", None), ("u", 0, "STANDARD", "level 1[0-9]"), ("v", 1, "S.*", "level 2|level 3"), ("none", 1, "nothing", None)], "var string, kind long, element string, level string")
    found = index_files.lookup(index, F.broadcast(wanted), ["kind", "element", "level"], ["element", "level"])  # four rows
    return index_files.lookup_faults(found, wanted, "file", "var", index)


@query("""with f as (select doc_id, '/' || lang || '/' || source || '/pressure-level-' || doc_id % 3 || '/' || doc_id || case when doc_id % 5 = 0 then '.txt' when doc_id % 2 = 0 then '.grib2.bz2' else '.grib2' end as path from documents where doc_id % 4 <> 1
union all select doc_id, '/' || lang || '/' || doc_id || '.grib2.bz2' from documents where doc_id % 4 = 1)
select doc_id, path from f where case when path like '%/pressure-level-1/%' then false when path like '%.grib2.bz2' then true when lang_en(path) then true else false end""".replace("lang_en(path)", "regexp_matches(path, '^/en/[^/]*/[^/]*/[^/]*\\.txt$')"))
def filtered_listing(spark: SparkSession, d: str) -> DataFrame:
    """A listing by ordered rules, the first that fits deciding."""
    docs, key = read(spark, d, "documents"), F.col("doc_id")
    name = F.concat(key.cast("string"), F.when(key % 5 == 0, ".txt").when(key % 2 == 0, ".grib2.bz2").otherwise(".grib2"))
    deep = F.concat(F.lit("/"), "lang", F.lit("/"), "source", F.lit("/pressure-level-"), (key % 3).cast("string"), F.lit("/"), name)
    path = F.when(key % 4 != 1, deep).otherwise(F.concat(F.lit("/"), "lang", F.lit("/"), key.cast("string"), F.lit(".grib2.bz2")))
    return index_files.filtered(docs.select("doc_id", path.alias("path")), "path", ["- pressure-level-1/*", "+ *.grib2.bz2", "+ /en/*/*/*.txt", "- **"])


@query("""with c as (select floor(epoch(ts))::bigint // 86400 as day, case when event_type <> 'error' then value end as v from events where not (floor(epoch(ts))::bigint // 3600 % 24 = 0 and event_type in ('click', 'error'))),
days as (select day, row_number() over (order by day desc) r from (select distinct floor(epoch(ts))::bigint // 86400 as day from events)),
f as (select days.day, r, coalesce(count(*) filter (c.day is not null and v is null)::double / nullif(count(c.day), 0), 0) fraction from days left join c using (day) where r <= 12 group by 1, 2),
t as (select *, [1.0, 0.3, 0.2][least(r, 3)] lim, row_number() over (order by md5('4:' || day), day desc) <= 8 as drawn from f)
select 'recent_missing' as "check", count(*) filter (drawn and lim < 1 and fraction > lim) = 0 as passed, count(*) filter (drawn and lim < 1 and fraction > lim) || ' positions over their limit' as message, count(*) filter (drawn and lim < 1) as checked from t""")
def recent_missing_sampled(spark: SparkSession, d: str) -> DataFrame:
    """Eight of the twelve newest days, without the first hour of the variables that have no value there."""
    e = read(spark, d, "events").select(F.floor(seconds("ts") / 86400).alias("day"), F.when(F.col("event_type") != "error", F.col("value")).alias("v"), (F.floor(seconds("ts") / 3600) % 24 == 0).alias("first"), "event_type")
    return checks.recent_missing(e, "day", "v", [1.0, 0.3, 0.2], window=12, sampled=8, seed=4, no_hour_0=F.col("first") & F.col("event_type").isin("click", "error"))


@query("""select p_type, count(distinct p_size) * count(distinct p_brand) * count(*) as n_messages, count(distinct p_size) * count(distinct p_brand) * count(*) * 55691 as bytes from part group by 1""")
def request_cost(spark: SparkSession, d: str) -> DataFrame:
    g = read(spark, d, "part").groupBy("p_type").agg(F.countDistinct("p_size").alias("f"), F.countDistinct("p_brand").alias("l"), F.count("*").alias("m"))
    return grid.request_cost(g, "f", "l", "m").select("p_type", "n_messages", "bytes")


@query("""with x as (select user_id, floor(epoch(ts))::bigint // 21600 * 21600 as sec from events group by 1, 2), p as (select user_id, sec, sec - lag(sec) over (partition by user_id order by sec) gap from x) select user_id, count(*) filter (gap > 21600) as n_gaps, max(gap) as longest from p group by 1""")
def series_gaps(spark: SparkSession, d: str) -> DataFrame:
    x = read(spark, d, "events").select("user_id", scalar.floor_to(seconds("ts"), 21600).alias("sec")).distinct()
    gap = F.col("sec") - F.lag("sec").over(Window.partitionBy("user_id").orderBy("sec"))
    return x.withColumn("gap", gap).groupBy("user_id").agg(F.count_if(F.col("gap") > 21600).alias("n_gaps"), F.max("gap").alias("longest"))


@query("""select 'null_fraction' as "check", count(*) filter (f > 0.35) = 0 as passed, count(*) filter (f > 0.35) || ' faults' as message, 0::bigint as checked from (select user_id, avg(case when event_type = 'error' then 1 else 0 end) f from events group by 1)""")
def fault_check(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events").withColumn("v", F.when(F.col("event_type") != "error", F.col("value")))
    return checks.no_rows(stats.null_fraction(e, ["user_id"], "v").where("fraction > 0.35"), "null_fraction")


@query("""with b as (select o_orderkey, o_totalprice + (o_orderkey % 5) - 2 as v from orders where o_orderkey % 13 <> 3)
select o_orderpriority, count(*) n, round(avg(o_totalprice), 4) mean, round(avg(v), 4) reference_mean, round(avg(o_totalprice - v), 4) bias, round(max(abs(o_totalprice - v)), 4) largest from orders join b using (o_orderkey) group by 1""")
def reference_comparison(spark: SparkSession, d: str) -> DataFrame:
    a = read(spark, d, "orders").select("o_orderkey", "o_orderpriority", F.col("o_totalprice").alias("v"))
    b = a.where("o_orderkey % 13 <> 3").withColumn("v", F.col("v") + F.col("o_orderkey") % 5 - 2)
    c = stats.comparison(a, b, ["o_orderkey"], ["o_orderpriority"], "v")
    return c.select("o_orderpriority", "n", *(F.round(x, 4).alias(x) for x in ("mean", "reference_mean", "bias", "largest")))


@query("""with e as (select u.u, d.day from (select distinct user_id u from events) u cross join (select distinct floor(epoch(ts))::bigint // 86400 as day from events) d),
p as (select distinct user_id u, floor(epoch(ts))::bigint // 86400 as day from events where event_type <> 'error')
select e.day, count(p.u) as n_present, coalesce(string_agg(e.u::varchar, ',' order by e.u) filter (p.u is null), '') as missing from e left join p on p.u = e.u and p.day = e.day group by 1""")
def probe_position(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events").select(F.col("user_id").alias("u"), F.floor(seconds("ts") / 86400).alias("day"), "event_type")
    expected = grid.product(e.select("u").distinct(), e.select("day").distinct())
    found = stats.probe(expected, e.where("event_type <> 'error'"), ["day"], "u")
    return found.select("day", "n_present", F.array_join(F.transform("missing", lambda x: x.cast("string")), ",").alias("missing"))


@query("""with x as (select event_type, floor(epoch(ts))::bigint // 86400 as day, avg(value) mean, stddev_pop(value) std from events group by 1, 2)
select event_type, round(avg(mean), 6) mean, round(min(mean), 6) least, round(max(mean), 6) most, round(avg(std), 6) std from x group by 1""")
def value_series(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events").withColumn("day", F.floor(seconds("ts") / 86400))
    by = stats.mean_std(e, ["event_type", "day"], "value")
    return stats.series_summary(by, ["event_type"]).select("event_type", *(F.round(c, 6).alias(c) for c in ("mean", "least", "most", "std")))


@query("""select 'decoded' as "check", count(*) filter (event_type = 'error') = 0 and count(value) > 0 as passed, count(*) filter (event_type = 'error') || ' errors' as message, count(*) as checked from events""")
def decode_health(spark: SparkSession, d: str) -> DataFrame:
    messages = read(spark, d, "events").withColumn("error", F.when(F.col("event_type") == "error", "bad message"))
    return checks.decoded(messages, "value", "error")


@query("""with c as (select epoch(o_orderdate)::bigint // 86400 // 90 as quarter, count(*) filter (o_orderstatus <> 'P')::double / count(*) ratio from orders group by 1),
t as (select *, row_number() over (order by quarter desc) r from c) select 'complete' as "check", count(*) filter (ratio < case r when 1 then 0.0 when 2 then 0.5 else 1.0 end) = 0 as passed,
count(*) filter (ratio < case r when 1 then 0.0 when 2 then 0.5 else 1.0 end) || ' incomplete positions' as message, count(*) as checked from t""")
def completeness_check(spark: SparkSession, d: str) -> DataFrame:
    c = read(spark, d, "orders").groupBy(F.floor(seconds("o_orderdate") / 86400 / 90).alias("quarter")).agg((F.count_if(F.col("o_orderstatus") != "P") / F.count("*")).alias("ratio"))
    return checks.complete(c, "quarter", [0.0, 0.5, 1.0])


@query("""with m as (select max(floor(epoch(ts))::bigint) hi, min(floor(epoch(ts))::bigint) lo from events), r as (select (hi - 7200) // 86400 * 86400 - k * 86400 as init, k + 1 as rank, lo from m, (select unnest(range(0, 45)) k))
select init, rank, case when init % 172800 = 0 then 4611686018427387904 else init end as probe from r where init >= lo""")
def recent_inits(spark: SparkSession, d: str) -> DataFrame:
    ends = read(spark, d, "events").agg(F.max(seconds("ts")).alias("hi"), F.min(seconds("ts")).alias("lo")).first()
    inits = grid.recent_inits(spark, ends.hi, 7200, 45, ends.lo)
    return inits.select("init", "rank", F.when(F.col("init") % 172800 == 0, grid.probe_order(F.lit(0))).otherwise(grid.probe_order(F.col("init"))).alias("probe"))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder of the shared one."""
    return f"{store.shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("""with x as (select distinct user_id, floor(epoch(ts))::bigint // 3600 * 3600 as sec from events)
select * from (select user_id, sec, sec - lag(sec) over (partition by user_id order by sec) as gap from x) where gap <> 3600""")
def contiguity(spark: SparkSession, d: str) -> DataFrame:
    x = read(spark, d, "events").select("user_id", scalar.floor_to(seconds("ts"), 3600).alias("sec")).distinct()
    return series.contiguous(x, "sec", 3600, ["user_id"], stretch=24)


STRUCTURES = """pa as (select s_name as path, s_nationkey::varchar as dims, 'float' as dtype, (s_suppkey % 4)::varchar as chunks, s_suppkey from supplier),
na as (select path, dims, dtype, case when s_suppkey % 5 = 2 then '9' else chunks end as chunks from pa where s_suppkey % 7 <> 3 union all select 'new ' || path, dims, dtype, chunks from pa where s_suppkey % 9 = 1),
pc as (select c_mktsegment as coord, c_custkey as index, c_acctbal as value from customer), nc as (select coord, index, case when coord = 'BUILDING' then value + 1 else value end as value from pc where coord <> 'MACHINERY'),
ps as (select o_orderpriority as "group", count(*) as size from orders group by 1), ns as (select "group", case substr("group", 1, 1) when '1' then size - 1 when '2' then size + 1 else size end as size from ps)"""


def structures(spark: SparkSession, d: str) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Published and new structures made from the test tables, as a template that has drifted."""
    s = read(spark, d, "supplier").select(F.col("s_name").alias("path"), F.col("s_nationkey").cast("string").alias("dims"), F.lit("float").alias("dtype"), (F.col("s_suppkey") % 4).cast("string").alias("chunks"), "s_suppkey")
    arrays = s.where("s_suppkey % 7 <> 3").withColumn("chunks", F.when(F.col("s_suppkey") % 5 == 2, "9").otherwise(F.col("chunks")))
    arrays = arrays.union(s.where("s_suppkey % 9 = 1").withColumn("path", F.concat(F.lit("new "), "path"))).drop("s_suppkey")
    coords = read(spark, d, "customer").select(F.col("c_mktsegment").alias("coord"), F.col("c_custkey").alias("index"), F.col("c_acctbal").alias("value"))
    moved = coords.where("coord <> 'MACHINERY'").withColumn("value", F.when(F.col("coord") == "BUILDING", F.col("value") + 1).otherwise(F.col("value")))
    sizes = read(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("group")).agg(F.count("*").alias("size"))
    first = F.left("group", F.lit(1))
    other = sizes.withColumn("size", F.col("size") + F.when(first == "1", -1).when(first == "2", 1).otherwise(0))
    return {"arrays": s.drop("s_suppkey"), "coords": coords, "sizes": sizes}, {"arrays": arrays, "coords": moved, "sizes": other}


ARRAY_DRIFT = """select path, 'missing' as fault, null as published, null as new from pa where path not in (select path from na) union all
select pa.path, 'chunks differs', pa.chunks, na.chunks from pa join na using (path) where pa.chunks <> na.chunks"""
COORD_DRIFT = """select distinct coord, 'missing', null, null from pc where coord not in (select coord from nc) union all select distinct coord, 'values differ', null, null from pc join nc using (coord, index) where pc.value <> nc.value"""


@query(f"with {STRUCTURES} {ARRAY_DRIFT} union all {COORD_DRIFT}")
def structural_drift(spark: SparkSession, d: str) -> DataFrame:
    published, new = structures(spark, d)
    return structure.array_drift(published["arrays"], new["arrays"]).union(structure.coordinate_drift(published["coords"], new["coords"]))


@query(f"""with {STRUCTURES} {ARRAY_DRIFT} union all {COORD_DRIFT} union all select path, 'new array', null, null from na where path not in (select path from pa)
union all select "group", 'trimming is never allowed', p.size::varchar, n.size::varchar from ps p join ns n using ("group") where n.size < p.size
union all select "group", 'growth is not allowed', p.size::varchar, n.size::varchar from ps p join ns n using ("group") where n.size > p.size""")
def safe_overwrite(spark: SparkSession, d: str) -> DataFrame:
    return structure.overwrite_faults(*structures(spark, d))


@query("""with p as (select p_brand as coord, p_partkey as index, p_retailprice as value from part), t as (select coord, index, case when coord <> (select min(coord) from p) then value + 1 end as value from p)
select coord, index, case when coord = (select min(coord) from p) then p.value else t.value end as value from p join t using (coord, index)""")
def state_coordinates(spark: SparkSession, d: str) -> DataFrame:
    """A refresh of coordinates leaves those that jobs write as they are published."""
    p = read(spark, d, "part").select(F.col("p_brand").alias("coord"), F.col("p_partkey").alias("index"), F.col("p_retailprice").alias("value"))
    least = p.agg(F.min("coord").alias("least"))  # one row
    t = p.join(F.broadcast(least)).select("coord", "index", F.when(F.col("coord") != F.col("least"), F.col("value") + 1).alias("value"))
    return structure.refreshed_coordinates(p, t)


@query("""with p as (select c_name as path, c_mktsegment as value from customer where c_custkey % 6 <> 1), t as (select c_name as path, case when c_custkey % 5 = 0 then 'other' else c_mktsegment end as value from customer where c_custkey % 7 <> 2)
select coalesce(p.path, t.path) as path, 'segment' as key, p.value as published, t.value as new from p full join t using (path) where p.value is distinct from t.value""")
def metadata_refresh(spark: SparkSession, d: str) -> DataFrame:
    c = read(spark, d, "customer").select(F.col("c_name").alias("path"), F.lit("segment").alias("key"), F.col("c_mktsegment").alias("value"), "c_custkey")
    t = c.where("c_custkey % 7 <> 2").withColumn("value", F.when(F.col("c_custkey") % 5 == 0, "other").otherwise(F.col("value")))
    return structure.refreshed_attributes(c.where("c_custkey % 6 <> 1"), t)


@query("""with m as (select max(o_orderkey) filter (o_orderstatus = 'P') as reach from orders) select o_orderkey, o_custkey from orders, m where o_orderkey <= reach""")
def trimmed_to_processed(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders")
    results = o.select("o_orderkey", F.when(F.col("o_orderstatus") == "P", "succeeded").otherwise("failed").alias("status"))
    return ingest.trimmed(o.select("o_orderkey", "o_custkey"), results, "o_orderkey", 0)


@query("""with e as (select p_brand as var, min(p_type) as element, min(p_name) as name from part group by 1),
x as (select p.p_brand as var, p.p_type <> e.element as f1, p.p_size % 3 <> 1 as f2, substr(p.p_brand, 7, 1) <> '1' and p.p_name <> e.name as f3 from part p join e on p.p_brand = e.var)
select var, 'element' as fault from x where f1 union all select var, 'comment' from x where f2 union all select var, 'description' from x where f3""")
def decoded_metadata(spark: SparkSession, d: str) -> DataFrame:
    """Fields whose element, comment or description isn't their variable's; brands with a 1 compare units only."""
    p = read(spark, d, "part")
    only_unit = F.substring("p_brand", 7, 1) == "1"
    found = p.select(F.col("p_brand").alias("var"), F.col("p_type").alias("element"), F.col("p_name").alias("description"), F.concat(F.when(only_unit, F.col("p_name")).otherwise("c"), F.lit(" ["), (F.col("p_size") % 3).cast("string"), F.lit("]")).alias("comment"))
    e = p.groupBy(F.col("p_brand").alias("var")).agg(F.min("p_type").alias("element"), F.min("p_name").alias("description"))
    e = e.withColumns({"comment": F.lit("c [1]"), "unit_only": F.substring("var", 7, 1) == "1", "categorical": F.lit(False)})
    return checks.metadata_faults(found, e)


@query("""with x as (select o_custkey, o_orderkey as start, o_orderstatus as element, o_orderpriority as level, o_custkey % 3 as hours, o_orderdate from orders)
select start, coalesce(min(start) over (partition by o_custkey % 16 order by start range between 1 following and unbounded following), start + 10737418240) as stop, strftime(o_orderdate, '%Y%m%d%H') as init, element, level, hours || ' hour fcst' as period from x""")
def text_index_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Text index files, one for each of 16 groups of customers, written and read with their byte ranges."""
    o = read(spark, d, "orders")
    line = F.concat_ws(":", "o_orderkey", "o_orderkey", F.concat(F.lit("d="), F.date_format("o_orderdate", "yyyyMMddHH")), "o_orderstatus", "o_orderpriority", F.concat((F.col("o_custkey") % 3).cast("string"), F.lit(" hour fcst")), F.lit(""))
    folder = scratch(spark, "text-index")
    o.select((F.col("o_custkey") % 16).alias("part"), line.alias("value")).repartition("part").write.partitionBy("part").text(folder)
    index = index_files.text_index(spark, folder)
    file = F.regexp_extract("file", "part=([^/]+)", 1).alias("file")
    return index_files.byte_ranges(index.withColumn("file", file), "file", "start").select("start", "stop", "init", "element", "level", "period")


@query("""select l_returnflag as param, l_quantity as levelist, case when l_partkey % 4 = 0 then 0 else l_partkey % 4 end as number, l_linenumber::bigint as step, l_orderkey as start, l_orderkey + l_suppkey as stop from lineitem where l_linestatus = 'O' and l_linenumber = 3""")
def json_index_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """JSON index lines written by the index sink and read back, of one kind and step; a missing number is 0."""
    n = F.col("l_partkey") % 4
    rows = read(spark, d, "lineitem").select(F.col("l_returnflag").alias("param"), F.lit("pl").alias("levtype"), F.col("l_quantity").cast("string").alias("levelist"), F.when(n != 0, n.cast("string")).alias("number"), F.col("l_linenumber").cast("string").alias("step"), F.col("l_linestatus").alias("type"), F.col("l_orderkey").alias("_offset"), F.col("l_suppkey").alias("_length"))
    folder = scratch(spark, "json-index")
    index_files.write_json_index(rows, folder)
    return index_files.json_index(spark, folder, kinds=("O",), step=3).select("param", "levelist", "number", "step", "start", "stop")


@query("""select event_id, user_id, case when user_id % 5 = 2 then value + 1 else value end as value, user_id % 5 as region from events""")
def publish_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """A table published whole, then one region of it again; the replica's rows."""
    e = read(spark, d, "events").select("event_id", "user_id", "value", (F.col("user_id") % 5).alias("region"))
    roots = [scratch(spark, "primary"), scratch(spark, "replica")]
    store.publish(e, roots, "region", "event_id", salt=F.col("event_id") % 4)
    store.publish(e.where("region = 2").withColumn("value", F.col("value") + 1), roots, "region", "event_id", only_regions=True)
    return store.read(spark, roots[1]).select("event_id", "user_id", "value", F.col("region").cast("long").alias("region"))


@query("""with h as (select user_id as x, floor(epoch(ts))::bigint // 3600 * 3600 as time, sum(round(value * 100)::bigint)::double as v from events group by 1, 2)
select x, time, 'scaled' as var, ((case when v::float <> 5000::float then v end) * 0.5 + 3)::float as value from h union all select x, time, 'plain', v::float from h""")
def backfill_and_update(spark: SparkSession, d: str) -> DataFrame:
    """A backfill of the first half and an update to the end equal a single pass; two variables of one treatment are one scan."""
    h = read(spark, d, "events").groupBy(F.col("user_id").alias("x"), scalar.floor_to(seconds("ts"), 3600).alias("time")).agg(F.sum(cents("value")).cast("double").alias("value"))
    cells = h.withColumn("var", F.explode(F.array(F.lit("scaled"), F.lit("plain"))))
    ends = h.agg(F.min("time").alias("lo"), F.max("time").alias("hi")).first()
    half = (ends.lo + ends.hi) // 7200 * 3600
    dataset = spec.Dataset("d", ("x",), "time", ends.lo // 86400 * 86400, 3600, 240, (spec.Variable("scaled", sentinel=5000.0, factor=0.5, offset=3.0), spec.Variable("plain")))
    roots = [scratch(spark, "ingest")]
    ingest.backfill(cells, dataset, roots, end=half)
    ingest.update(cells, dataset, roots)
    return store.read(spark, roots[0]).select("x", "time", "var", "value")


@query(f"""with {HOURLY}, p as (select *, lag(sec) over w ps, lag(acc) over w pa from a window w as (partition by user_id order by sec)),
r as (select user_id, sec, (acc - case when ps % 86400 = 0 then 0 else pa end)::double / (sec - ps) raw from p) select user_id as x, sec as time, ({CLAMPED})::float as value from r""")
def update_of_rates(spark: SparkSession, d: str) -> DataFrame:
    """Rates of series with missing hours: a backfill of the first half, an update to three quarters and one to the end equal a single pass."""
    cells = hourly(spark, d).select(F.col("user_id").alias("x"), F.col("sec").alias("time"), F.lit("rain").alias("var"), F.col("acc").cast("double").alias("value"))
    ends = cells.agg(F.min("time").alias("lo"), F.max("time").alias("hi")).first()
    step = (ends.hi - ends.lo) // (4 * 3600) * 3600
    dataset = spec.Dataset("d", ("x",), "time", ends.lo // 86400 * 86400, 3600, 36, (spec.Variable("rain", rate="accumulated", reset=86400),))
    roots = [scratch(spark, "rates")]
    ingest.backfill(cells, dataset, roots, end=ends.lo + 2 * step)
    ingest.update(cells.where(F.col("time") < ends.lo + 3 * step), dataset, roots)
    ingest.update(cells, dataset, roots)
    return store.read(spark, roots[0]).select("x", "time", "value")


@query("""select distinct user_id, floor(epoch(ts))::bigint // 3600 as hour from events""")
def stream_append(spark: SparkSession, d: str) -> DataFrame:
    """Each key once, appended by micro-batches; the keys are the stream's state."""
    folder = scratch(spark, "append")
    rows = read(spark, d, "events").select("user_id", F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("at"))
    rows.repartition(4).write.parquet(f"{folder}/in")
    stream = updates.read_files(spark, f"{folder}/in", rows.schema, files_per_batch=2)
    updates.append_within(stream, f"{folder}/out", f"{folder}/state", ["user_id", "at"], "at", "3650 days").awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("user_id", F.floor(F.unix_timestamp("at") / 3600).alias("hour"))


@query("""with f as (select user_id, floor(epoch(ts))::bigint // 3600 * 3600 as sec, event_id from events),
w as (select max(sec) filter (event_id % 2 = 0) - 432000 as w1 from f)
select distinct user_id, sec from f, w where event_id % 2 = 0 or event_id % 3 = 0 or sec > w1""")
def late_files(spark: SparkSession, d: str) -> DataFrame:
    """Three deliveries that repeat each other: the third's late keys are accepted up to five days behind the first, older ones refused."""
    folder = scratch(spark, "late")
    e = read(spark, d, "events").select("user_id", F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("at"), "event_id")
    for delivery in ("event_id % 2 = 0", "event_id % 3 = 0", "true"):
        e.where(delivery).drop("event_id").repartition(2).write.mode("append").parquet(f"{folder}/in")
    stream = updates.read_files(spark, f"{folder}/in", e.drop("event_id").schema, files_per_batch=2)
    updates.append_within(stream, f"{folder}/out", f"{folder}/state", ["user_id", "at"], "at", "5 days").awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("user_id", F.unix_timestamp("at").alias("sec"))


@query("select 2::bigint as n_batches, count(*) as n_input, max(event_id) as newest from events")
def stream_progress(spark: SparkSession, d: str) -> DataFrame:
    """What the batches of a stream report: rows taken and a metric observed in the write."""
    folder, log = scratch(spark, "progress"), updates.Progress()
    rows = read(spark, d, "events").select("user_id", "event_id")
    rows.repartition(4).write.parquet(f"{folder}/in")
    spark.streams.addListener(log)
    try:
        stream = updates.read_files(spark, f"{folder}/in", rows.schema, files_per_batch=2).observe("batch", F.max("event_id").alias("newest"))
        q = stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
        q.awaitTermination()
        done = log.rows(q).where("input_rows > 0")
    finally:
        spark.streams.removeListener(log)
    newest = F.get_json_object(F.col("observed")["batch"], "$.newest").cast("long")
    return done.agg(F.countDistinct("batch").alias("n_batches"), F.sum("input_rows").alias("n_input"), F.max(newest).alias("newest"))


@query("""with g as (select p_partkey // 20 as y, p_partkey % 20 as x, 20.0::double + p_partkey // 20 * 0.25::double + p_partkey % 20 * 0.03125::double as a, -120.0::double + p_partkey % 20 * 0.5::double - p_partkey // 20 * 0.0625::double as o from part),
p as (select c_custkey, 20.0::double + c_custkey % 97 * 0.3125::double as lat, -121.0::double + c_custkey % 89 * 0.140625::double as lon from customer),
r as (select c_custkey, y, x, row_number() over (partition by c_custkey order by (a - lat) * (a - lat) + ((o - lon) * cos(radians(lat))) * ((o - lon) * cos(radians(lat))), y, x) i from p, g)
select c_custkey, y, x from r where i = 1""")
def nearest_cell_2d(spark: SparkSession, d: str) -> DataFrame:
    """The nearest cell of a slanted grid."""
    key = F.col("p_partkey")
    y, x = F.floor(key / 20), key % 20
    cells = read(spark, d, "part").select(y.alias("y"), x.alias("x"), (20.0 + y * 0.25 + x * 0.03125).alias("lat"), (-120.0 + x * 0.5 - y * 0.0625).alias("lon"))
    points = read(spark, d, "customer").select("c_custkey", (20.0 + F.col("c_custkey") % 97 * 0.3125).alias("lat"), (-121.0 + F.col("c_custkey") % 89 * 0.140625).alias("lon"))
    return spatial.nearest_cell_2d(points, cells, ["y", "x"]).select("c_custkey", "y", "x")


@query("""with m as (select o_orderkey % 4 as part, o_orderkey, 32 + o_orderkey % 90 as length, o_orderkey % 10 as discipline from orders)
select part, row_number() over (partition by part order by o_orderkey) - 1 as message, (sum(length) over (partition by part order by o_orderkey) - length)::bigint as start, length, discipline from m""")
def framed_ranges(spark: SparkSession, d: str) -> DataFrame:
    """Files of framed messages, an order each, read by ranges of 64 KB."""
    folder, key = scratch(spark, "framed"), F.col("o_orderkey")
    length = 32 + key % 90
    zeros = lambda n: F.lit("\0" * n)
    value = F.concat(F.lit("GRIB"), zeros(2), F.char(key % 10), F.char(F.lit(2)), zeros(7), F.char(length), F.expr("repeat('x', cast(12 + o_orderkey % 90 as int))"))
    rows = read(spark, d, "orders").select((key % 4).alias("part"), "o_orderkey", value.alias("value"))
    rows.repartition("part").sortWithinPartitions("part", "o_orderkey").drop("o_orderkey").write.partitionBy("part").option("lineSep", "7777").text(folder)
    found = ranged.numbered(ranged.message_ranges(spark, folder, 1 << 16))
    return found.select(F.regexp_extract("file", "part=([0-9]+)", 1).cast("long").alias("part"), "message", "start", "length", "discipline")


@query("""with l as (select doc_id, 's3://' || source || '/' || lang || '/' || doc_id || '.grib2' as location from documents),
r as (select distinct 's3://' || source || '/' as prefix, 'source' as kind from documents where ascii(right(source, 1)) % 2 = 0 union all select distinct 's3://' || source || '/' || lang || '/', 'language' from documents where lang in ('en', 'de')
union all select 's3://' || source || '/' || lang || '/1', 'shard' from (select distinct source, lang from documents))
select doc_id, r.prefix, r.kind from l left join r on starts_with(location, r.prefix) qualify row_number() over (partition by doc_id order by length(r.prefix) desc nulls last) = 1""")
def registered_locations(spark: SparkSession, d: str) -> DataFrame:
    """The longest registered prefix of each location; locations without one are to be refused."""
    docs = read(spark, d, "documents").select("doc_id", "source", "lang")
    base = F.concat(F.lit("s3://"), "source", F.lit("/"))
    deeper = F.concat(base, "lang", F.lit("/"))
    registered = docs.where(F.ascii(F.right("source", F.lit(1))) % 2 == 0).select(base.alias("prefix"), F.lit("source").alias("kind"))
    registered = registered.union(docs.where("lang in ('en', 'de')").select(deeper, F.lit("language"))).union(docs.select(F.concat(deeper, F.lit("1")), F.lit("shard"))).distinct()
    locations = docs.select("doc_id", F.concat(deeper, F.col("doc_id").cast("string"), F.lit(".grib2")).alias("location"))
    return align.longest_prefix(locations, "location", registered, "prefix", ["kind"]).select("doc_id", "prefix", "kind")


@query("""with p as (select l_orderkey, l_linenumber, l_partkey, (l_quantity * 100)::bigint as length from lineitem), n as (select l_orderkey, l_linenumber, max(l_partkey) as l_partkey, max(length) as length from p group by 1, 2)
select 'order-' || l_orderkey as file, l_linenumber::bigint as message, (sum(length) over (partition by l_orderkey order by l_linenumber) - length)::bigint as "offset", length from n""")
def message_references(spark: SparkSession, d: str) -> DataFrame:
    """Orders as files, their lines as messages: each file's references."""
    parts = read(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max((F.col("l_quantity") * 100).cast("long")).alias("length"))
    return index_files.references(parts.select(F.concat(F.lit("order-"), F.col("l_orderkey").cast("string")).alias("file"), F.col("l_linenumber").cast("long").alias("message"), "length"))


@query("""select o_orderkey, '{"init":{"__t":"ts","v":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') || '"},"lead":{"__t":"td","v":"' || case when o_orderkey % 5 < 2 then '-' else '' end || 'PT' || abs((o_orderkey % 5 - 2) * 3600) || 'S"},"member":' || (o_orderkey % 7) || '}' as place,
o_orderdate::timestamp as init, (o_orderkey % 5 - 2) * 3600 as lead, o_orderkey % 7 as member, null::bigint as init_as_lead from orders""")
def tagged_places(spark: SparkSession, d: str) -> DataFrame:
    """Places as JSON with tagged times and spans, and read back typed."""
    o = read(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp_ntz").alias("at"))
    place = scalar.tagged_place({"init": ("ts", F.col("at")), "lead": ("td", (F.col("o_orderkey") % 5 - 2) * 3600), "member": ("plain", F.col("o_orderkey") % 7)})
    init, lead, member = scalar.untagged("place", {"init": "ts", "lead": "td", "member": "bigint"})
    (wrong,) = scalar.untagged("place", {"init": "td"})
    return o.select("o_orderkey", place.alias("place")).select("o_orderkey", "place", init.alias("init"), lead.alias("lead"), member.alias("member"), wrong.alias("init_as_lead"))


@query("""select event_type, floor(epoch(ts))::bigint // 3600 * 3600 as start, count(*) as n, sum(round(value * 100)::bigint)::bigint as total from events group by 1, 2""")
def stream_windows(spark: SparkSession, d: str) -> DataFrame:
    """Windowed statistics of a stream, complete after its last batch."""
    folder = scratch(spark, "windows")
    rows = read(spark, d, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type", cents("value").alias("v"))
    rows.repartition(8).write.parquet(f"{folder}/in")
    found = updates.windowed_stats(updates.read_files(spark, f"{folder}/in", rows.schema, files_per_batch=8), "ts", ["event_type"], "v")

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/out")

    found.writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("event_type", F.unix_timestamp("start").alias("start"), "n", "total")


@query("""select o_orderkey from orders where o_orderkey not in (select l_orderkey from lineitem where l_returnflag = 'R') and o_orderkey in (select l_orderkey from lineitem where l_linenumber >= 3)""")
def pending_sweep(spark: SparkSession, d: str) -> DataFrame:
    """Work of one sweep: expected, not published, listed."""
    l = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_returnflag", "l_linenumber")
    return updates.pending(read(spark, d, "orders").select("o_orderkey"), l.where("l_returnflag = 'R'"), l.where("l_linenumber >= 3"), ["o_orderkey"])


@query("""select c_custkey, 0.25 + 0.5 / 2 + (c_custkey % 40) * 0.5 as centre, 39 - c_custkey % 40 as y, c_custkey // 40 as x,
pow(c_acctbal / 100 - 10, 2) + pow((c_nationkey - 5) * cos(radians(10.0::double)), 2) as distance, c_mktsegment as dataset, 'v' || c_nationkey as version from customer""")
def raster_functions(spark: SparkSession, d: str) -> DataFrame:
    c = read(spark, d, "customer").withColumns({"y": F.floor(F.col("c_custkey") / 40), "x": F.col("c_custkey") % 40})
    turned = raster.flip_transpose(c, 40)
    dataset, version = scalar.dataset_and_version(F.concat(F.lit("https://h.example/"), "c_mktsegment", F.lit("/v"), F.col("c_nationkey").cast("string"), F.lit(".zarr/")))
    distance = scalar.planar_distance(F.col("c_acctbal") / 100, F.col("c_nationkey").cast("double"), F.lit(10.0), F.lit(5.0))
    return turned.select("c_custkey", raster.pixel_centre(F.col("c_custkey") % 40, 0.25, 0.5).alias("centre"), "y", "x", distance.alias("distance"), dataset.alias("dataset"), version.alias("version"))


@query("""with f as (select floor(epoch(ts))::bigint // 86400 as day, avg(case when event_type = 'error' then 1 else 0 end) as fraction from events group by 1), r as (select *, row_number() over (order by day desc) rank from f),
b as (select count(*) filter (fraction > case rank when 1 then 0.5 when 2 then 0.3 else 0.1 end) as bad, count(*) n from r where rank <= 3),
c as (select 'recent_missing' as "check", bad = 0 and n = 3 as passed, bad || ' positions over their limit' as message, n as checked from b union all
select 'no_faults', count(*) = 0, count(*) || ' faults', 0 from events where event_type = 'none')
select "check", passed, message, checked::bigint as checked, substr(sha256((select coalesce(string_agg("check", ',' order by "check") filter (not passed), '') from c)), 1, 8) as fingerprint from c""")
def check_report(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events").select(F.floor(seconds("ts") / 86400).alias("day"), F.when(F.col("event_type") != "error", F.col("value")).alias("v"), "event_type")
    return checks.report([checks.recent_missing(e, "day", "v", [0.5, 0.3, 0.1]), checks.no_rows(e.where("event_type = 'none'"), "no_faults")])


@query("""with i as (select c_custkey as i from customer) select i // 64 as region, i // 64 * 64 as start, least((i // 64 + 1) * 64, max(i) + 1) as stop from i group by 1, 2""")
def region_plan(spark: SparkSession, d: str) -> DataFrame:
    return grid.regions(read(spark, d, "customer").select(F.col("c_custkey").alias("i")), "i", 64)


def _shares(axes: dict[str, int], sizes: str) -> str:
    """SQL of the evenness of tiles along each axis, summed."""
    one = "(1 - sqrt(((ceil({n} / {d}) - 1) * pow({d} - {n} / ceil({n} / {d}), 2) + pow({n} - (ceil({n} / {d}) - 1) * {d} - {n} / ceil({n} / {d}), 2)) / ceil({n} / {d})) / ({n} / ceil({n} / {d})))"
    return " + ".join(one.format(n=f"{n}::double", d=sizes.format(d=d, n=n)) for d, n in axes.items())


AXES = {"time": 720, "latitude": 721, "longitude": 1440}
SQL["layout_score"] = (
    "with " + ", ".join(f"{d}s as (select distinct ceil({n}::double / k)::bigint as {d} from range(1, {n + 1}) t(k))" for d, n in AXES.items())
    + f", c as (select *, (time * latitude * longitude)::double * {layout.BYTES * layout.COMPRESSION / 1e6!r} as mb from times, latitudes, longitudes)"
    + f" select *, round(0.3 * (1 - abs(mb - 3.5) / 3.5) + 0.4 * (({_shares(AXES, '{d}')}) / 3) + 0.3 * (least(latitude, longitude)::double / greatest(latitude, longitude)), 9) as score from c where mb between 2.5 and 6 order by score desc, time, latitude, longitude limit 20"
)
CHUNK = {"time": 24, "latitude": 181, "longitude": 180}


@query(
    "with " + ", ".join(f"{d}s as (select {CHUNK[d]} * k as {d} from range(1, {-(-n // CHUNK[d]) + 1}) t(k))" for d, n in AXES.items())
    + f", c as (select *, (time * latitude * longitude)::double * {layout.BYTES * layout.COMPRESSION / 1e6!r} as mb from times, latitudes, longitudes),"
    + f" s as (select *, round(0.25 * (1 - abs(mb - 300) / 1200) + 0.45 * (({_shares(AXES, 'least({d}, {n})')}) / 3) + 0.30 * (least(latitude, longitude)::double / greatest(latitude, longitude)), 9) as score from c where mb between 100 and 1200 order by score desc, time, latitude, longitude limit 10)"
    + " select time, latitude, longitude, score, ceil(721::double / latitude) * ceil(1440::double / longitude) * mb as slice_mb, ceil(720::double / time) * mb as series_mb from s"
)
def shard_layout(spark: SparkSession, d: str) -> DataFrame:
    """The best shards of a chunking, with the MB that a time step of the whole grid and a point's series read."""
    found = layout.shard_shapes(spark, AXES, CHUNK, ("latitude", "longitude"))
    return layout.access_cost(found, AXES, ("latitude", "longitude"), "time").drop("mb")
