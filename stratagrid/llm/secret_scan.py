"""Secret scans with multipart credential linking, in DataFrame functions only.

Base findings are assignments (`password = ...`), access identifiers (`AKIA...`) and
long hexadecimal runs. Weak candidates - a user or client name, a long random-looking
token, an endpoint - say little by themselves. They are reported only when a
complementary part stands within `SCOPE` characters: names and endpoints need a secret
(of any strength), tokens need an identifier or an endpoint. Parts meet in an interval
join over bins of `SCOPE` characters within a document.

Texts are read once. Positions come from the lengths of a pattern's matches and of the
pieces between them, and only for texts that a cheap test doesn't exclude.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Workspace

KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS, ACCESS_LENGTH = "AKIA[A-Z0-9]+", 20
HEX, HEX_LENGTH = "[0-9a-f]+", 24
ASSIGN_LENGTH = 6
#: Weak kinds: pattern and the part it plays.
NAME = "(?:[Uu]ser(?:name)?|[Ll]ogin|[Cc]lient_?[Ii]d|[Aa]ccount(?:_?[Ii]d)?|[Kk]ey_?[Ii]d)[\"']?\\x20*[:=]\\x20*[\"']?[A-Za-z0-9@._-]{3,}"
TOKEN = "[A-Za-z0-9+/_-]{32,}=*"
ENDPOINT = "(?:https?|jdbc|s3|ftp|amqp|redis|postgres(?:ql)?|mysql|mongodb)://[A-Za-z0-9.:@/_?&=%-]+"
SCOPE = 200
#: Where a letter and a digit meet; random tokens of 32 characters have about 8 with both cases and 12 with one.
TURN = "(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])"
TURNS_MIXED, TURNS_ANY = 3, 6
UUID = "^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$"
KINDS = ("assign", "access", "hex", "name", "token", "endpoint")

SPAN = "array<struct<start: int, kind: int, end: int>>"


def running(sizes: Column) -> Column:
    """Sums of the first 1, 2, ... of an array of numbers, by doubling: n log n steps."""
    shifts = F.filter(F.array(*(F.lit(1 << k) for k in range(31))), lambda d: d < F.size(sizes))
    return F.aggregate(shifts, sizes, lambda acc, d: F.transform(acc, lambda x, i: x + F.coalesce(F.get(acc, i - d), F.lit(0))))


def spans(text: Column, pattern: str, kind: int, least: int = 0, group: int = 0) -> Column:
    """[(start, kind, end)] of the leftmost, not overlapping matches whose group has `least` characters or more."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = [whole.alias("m"), F.split(text, pattern, -1).alias("gap")]
    if group:
        parts.append(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("g"))
    zipped = F.filter(F.arrays_zip(*parts), lambda z: z["m"].isNotNull())

    def placed(found: Column) -> Column:
        sizes = F.transform(found, lambda z: F.struct(F.length(z["m"]).alias("size"), F.length(z["g"] if group else z["m"]).alias("counts"), (F.length(z["gap"]) + F.length(z["m"])).alias("step")))
        return F.get(F.transform(F.array(sizes), ends), F.lit(0))  # a lambda's variable, so that it is computed once

    def ends(sizes: Column) -> Column:
        steps = F.get(F.transform(F.array(F.transform(sizes, lambda z: z["step"])), running), F.lit(0))
        whole = F.zip_with(sizes, steps, lambda z, e: F.struct((e - z["size"]).alias("start"), F.lit(kind).alias("kind"), e.alias("end"), z["counts"].alias("counts")))
        return F.transform(F.filter(whole, lambda s: s["counts"] >= least), lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))

    return F.get(F.transform(F.array(zipped), placed), F.lit(0))


def _strong(text: Column, token: Column, endpoint: Column) -> Column:
    """Of the `token` spans those that look random and are no part of an endpoint but for a value after `=`."""

    def random(s: Column) -> Column:
        piece = F.substr(text, s["start"] + 1, s["end"] - s["start"])
        turns = F.regexp_count(piece, F.lit(TURN))
        mixed = F.regexp_like(piece, F.lit("[a-z]")) & F.regexp_like(piece, F.lit("[A-Z]"))
        looks = ((turns >= TURNS_MIXED) & mixed | (turns >= TURNS_ANY)) & ~F.regexp_like(piece, F.lit(UUID))
        inside = F.exists(endpoint, lambda e: (e["start"] < s["end"]) & (s["start"] < e["end"]))
        return looks & (~inside | (s["start"] > 0) & (F.substr(text, s["start"], F.lit(1)) == "="))

    return F.filter(token, random)


def _joined(found: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.concat_ws(",", F.transform(F.array_sort(found), lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))))


def secret_spans(docs: DataFrame, ws: Workspace, scope: int = SCOPE) -> DataFrame:
    """(doc_id, base, linked, strong), a row for each row of `docs` (doc_id, text): sorted spans (start, kind, end), kinds as in KINDS.

    base holds assignments, access identifiers and hexadecimal runs; linked the weak
    candidates that complementary parts confirm and that overlap no base span; strong the
    linked tokens that look random, while any run of token characters may be in linked.
    Positions are code points. Null and empty texts have none; null doc_ids stay.
    """
    text, none = F.col("text"), F.array().cast(SPAN)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    lower = F.lower(text)
    some = lower.contains(KEYWORDS[0])
    for k in KEYWORDS[1:]:
        some = some | lower.contains(k)
    # a secret of some strength must be there for anything to be reported
    rows = rows.select("doc_id", "text", some.alias("has_assign"), text.contains("AKIA").alias("has_access"), text.rlike(f"[0-9a-f]{{{HEX_LENGTH}}}").alias("has_hex"), text.rlike(TOKEN).alias("has_token"))
    any_secret = F.expr("has_assign or has_hex or has_token")
    found = rows.select(
        "doc_id",
        F.xxhash64("text").alias("text_id"),
        F.when(F.col("has_assign"), spans(text, ASSIGN, 0, ASSIGN_LENGTH, 2)).otherwise(none).alias("assign"),
        F.when(F.col("has_access"), spans(text, ACCESS, 1, ACCESS_LENGTH)).otherwise(none).alias("access"),
        F.when(F.col("has_hex"), spans(text, HEX, 2, HEX_LENGTH)).otherwise(none).alias("hex"),
        F.when(any_secret & text.rlike(NAME), spans(text, NAME, 3)).otherwise(none).alias("name"),
        F.when(F.col("has_token"), spans(text, TOKEN, 4)).otherwise(none).alias("token"),
        F.when(any_secret & text.contains("://"), spans(text, ENDPOINT, 5)).otherwise(none).alias("endpoint"),
        F.when(F.col("has_token"), F.col("text")).otherwise("").alias("text"),
    )
    found = found.withColumn("strong", F.when(F.size("token") > 0, _strong(F.col("text"), F.col("token"), F.col("endpoint"))).otherwise(none))
    found = found.select("doc_id", "text_id", F.array_sort(F.concat("assign", "access", "hex")).alias("base"), F.concat("name", "token", "endpoint").alias("weak"), "strong")
    found = ws.cut(found)

    parts = found.where("size(weak) > 0").dropDuplicates(["doc_id", "text_id"])
    parts = parts.select("doc_id", "text_id", F.explode(F.concat("base", "weak")).alias("s")).select("doc_id", "text_id", "s.*")
    # roles: 0 and 2 and 4 are secrets, 1 and 3 identifiers, 5 endpoints
    bins = lambda reach: F.explode(F.sequence(F.floor((F.col("start") - reach) / scope), F.floor((F.col("end") + reach) / scope)))
    weak = parts.where("kind >= 3").withColumn("bin", bins(scope)).alias("w")
    other = parts.withColumn("bin", bins(0)).alias("o")
    same = F.expr("w.text_id = o.text_id and w.bin = o.bin and w.doc_id <=> o.doc_id")
    near = F.expr(f"o.start - w.end <= {scope} and w.start - o.end <= {scope}")
    clash = parts.where("kind < 3").withColumn("bin", bins(0)).alias("o")
    complement = F.expr("case when w.kind = 4 then o.kind in (1, 3, 5) else o.kind in (0, 2, 4) end") & F.expr("o.end <= w.start or w.end <= o.start")
    linked = weak.join(other, same & near & complement, "left_semi").select("w.*").dropDuplicates(["doc_id", "text_id", "start", "kind", "end"])
    overlap = F.expr("w.text_id = o.text_id and w.doc_id <=> o.doc_id and w.bin = o.bin and o.start < w.end and w.start < o.end")
    linked = linked.withColumn("bin", bins(0)).alias("w").join(clash, overlap, "left_anti").groupBy("doc_id", "text_id", "start", "kind", "end").agg(F.count("*").alias("n"), F.max("bin").alias("m"))
    linked = linked.where(F.expr(f"n = floor(end / {scope}) - floor(start / {scope}) + 1"))  # no bin of it met a base span
    linked = linked.groupBy("doc_id", "text_id").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("linked"))
    l, r = found.select("doc_id", "text_id", "base", "strong").alias("l"), linked.alias("r")
    linked = F.coalesce("linked", none)
    return l.join(r, F.expr("l.text_id = r.text_id and l.doc_id <=> r.doc_id"), "left").select("l.doc_id", "base", linked.alias("linked"), F.array_intersect(linked, "strong").alias("strong"))


def secret_report(found: DataFrame) -> DataFrame:
    """The contract's columns from `secret_spans`, and n_linked."""
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.size("linked").cast("long").alias("n_linked"),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.concat("base", "linked")).alias("spans"),
    )
