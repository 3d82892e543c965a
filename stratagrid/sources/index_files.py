"""Sources: message indexes, byte ranges, listings and framed binary files.

Index files are read by Spark's text and JSON readers; each line is a row with its
file's name, so that a listing of a million files is one scan.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.segments import following

# Fixed value: bytes after the last message's start, where the file's size isn't known.
PAD = 10 << 30


def text_index(spark: SparkSession, path: str) -> DataFrame:
    """(file, message, start, init, element, level, period) of lines `number:start:d=init:element:level:period:`."""
    p = F.split("value", ":")
    lines = spark.read.text(path).where(F.col("value").rlike(r"^\d+:\d+:"))
    return lines.select(F.col("_metadata.file_path").alias("file"), p[0].cast("long").alias("message"), p[1].cast("long").alias("start"), F.regexp_replace(p[2], "^d=", "").alias("init"), p[3].alias("element"), p[4].alias("level"), p[5].alias("period"))


#: Bytes of a stretch of a file; stretches of one file are worked on by different tasks.
STRETCH = 1 << 30


def byte_ranges(index: DataFrame, file: str, start: str, size: Column | None = None) -> DataFrame:
    """`index` with `stop`: where the next message of the file starts; of the last, the file's size or start + PAD.

    Messages that share a start (parts of one message) share the range.
    """
    after = following(index, [file], start, F.floor(F.col(start) / STRETCH), "__after")
    stop = F.coalesce("__after", size, F.col(start) + PAD) if size is not None else F.coalesce("__after", F.col(start) + PAD)
    return after.withColumn("stop", stop).drop("__after")


def lookup(index: DataFrame, wanted: DataFrame, on: list[str], patterns: list[str] | None = None) -> DataFrame:
    """`wanted` (var, and a value or pattern for each of `on`) joined with messages; a message may serve several vars.

    Columns of `on` are equal, or, if named in `patterns`, match as whole by the regular
    expression of `wanted` (as `TMP|TEMP`). A NULL of `wanted` fits any. Without
    patterns and NULLs it is an equality join; otherwise give columns that are always
    equal first, so that the join has a key.
    """
    keyed = [c for c in on if c not in (patterns or [])]
    if not patterns:
        return index.join(wanted, keyed, "inner")
    rows = wanted.select(*(F.col(c).alias(f"__{c}") if c in on else F.col(c) for c in wanted.columns))
    same = [F.col(c) == F.col(f"__{c}") for c in keyed]
    fits = [F.col(f"__{c}").isNull() | F.expr(f"regexp_like(`{c}`, concat('^(?:', `__{c}`, ')$'))") for c in patterns]
    return index.join(rows, reduce(lambda a, b: a & b, [*same, *fits])).drop(*(f"__{c}" for c in on))


def lookup_faults(found: DataFrame, wanted: DataFrame, file: str, var: str, files: DataFrame | None = None) -> DataFrame:
    """(file, var, n) of vars that a file doesn't have exactly once; absent ones count if `files` lists the files."""
    n = found.groupBy(file, var).agg(F.count("*").alias("n"))
    if files is not None:
        every = files.select(file).distinct().crossJoin(F.broadcast(wanted.select(var).distinct()))  # every file must have every var
        n = every.join(n, [file, var], "left").select(file, var, F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    return n.where("n <> 1")


def json_index(spark: SparkSession, path: str, kinds: tuple[str, ...] | None = None, step: int | None = None) -> DataFrame:
    """(file, param, levtype, levelist, number, step, start, stop) of JSON lines with _offset and _length; a missing number is 0.

    kinds: the values of `type` that are taken (as cf and fc), step: the only step; all otherwise.
    """
    schema = "param string, levtype string, levelist string, number string, step string, type string, _offset long, _length long"
    d = spark.read.schema(schema).json(path)
    if kinds is not None:
        d = d.where(F.col("type").isin(*kinds))
    if step is not None:
        d = d.where(F.col("step").cast("long") == step)
    return d.select(F.col("_metadata.file_path").alias("file"), "param", "levtype", F.col("levelist").cast("double").alias("levelist"), F.coalesce(F.col("number").cast("long"), F.lit(0)).alias("number"), F.col("step").cast("long").alias("step"), F.col("_offset").alias("start"), (F.col("_offset") + F.col("_length")).alias("stop"))


def param_by_lead(lead: Column, overrides: list[tuple[int, int, str]], default: Column) -> Column:
    """The first (start <= lead <= end) range's parameter, else the default."""
    out = None
    for a, b, p in overrides:
        cond = (lead >= a) & (lead <= b)
        out = F.when(cond, p) if out is None else out.when(cond, p)
    return default if out is None else out.otherwise(default)


def drop_stale_files(ranges: DataFrame, file: str, size: str) -> DataFrame:
    """Without all rows of files that have a range outside them; aggregates before it joins."""
    bad = ranges.where((F.col("start") < 0) | (F.col("stop") > F.col(size))).select(file).distinct()
    return ranges.join(bad, file, "left_anti")


def listing(spark: SparkSession, path: str, pattern: str = "*", min_age_seconds: int = 60) -> DataFrame:
    """(path, length, modified) of files, recursively, no younger than a minute."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return files.select("path", "length", F.col("modificationTime").alias("modified")).where(F.unix_timestamp("modified") <= F.unix_timestamp(F.current_timestamp()) - min_age_seconds)


def _glob(pattern: str) -> str:
    """A regular expression for a glob: `**` crosses folders, `*` and `?` don't; a pattern without a slash at its start fits at any folder."""
    parts = re.split(r"(\*\*|\*|\?)", pattern.lstrip("/"))
    body = "".join({"**": ".*", "*": "[^/]*", "?": "[^/]"}.get(x, re.escape(x)) for x in parts)
    return ("^/?" if pattern.startswith("/") else "(^|/)") + body + "$"


def filtered(files: DataFrame, path: str, rules: list[str]) -> DataFrame:
    """`files` by ordered rules `+ glob` and `- glob`: the first that fits a path decides; paths that none fits stay. NULL paths go."""
    keep = F.lit(True)
    for rule in reversed(rules):
        sign, _, glob = rule.partition(" ")
        if sign not in "+-" or not glob:
            raise ValueError(f"no rule: {rule}")
        keep = F.when(F.col(path).rlike(_glob(glob)), F.lit(sign == "+")).otherwise(keep)
    return files.where(F.col(path).isNotNull() & keep)


def _frames(magic: bytes, trailer: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                blob, at, number = content.as_py(), 0, 0
                while at < len(blob):
                    head = blob[at : at + len(magic)] == magic and len(blob) >= at + 16
                    size = struct.unpack(">Q", blob[at + 8 : at + 16])[0] if head else 0
                    if size < 20 or blob[at + size - len(trailer) : at + size] != trailer:
                        rows.append((path, number, at, None, None, "the message has no end" if head else "no message starts here"))
                        break
                    rows.append((path, number, at, size, blob[at + 6], None))
                    at, number = at + size, number + 1
            cols = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), *(pa.array(c, pa.int64()) for c in cols[1:5]), pa.array(cols[5], pa.string())], ["file", "message", "start", "length", "discipline", "error"])

    return run


def message_frames(spark: SparkSession, path: str, magic: bytes = b"GRIB", trailer: bytes = b"7777") -> DataFrame:
    """(file, message, start, length, discipline, error) of files of framed messages: magic, length in bytes 8 to 15, trailer.

    Where a file doesn't go on with a whole message, a row says so in `error`; other files go on.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_frames(magic, trailer), "file string, message long, start long, length long, discipline long, error string")


def refs(ranges: DataFrame, var: str, dims: list[str], location: str) -> DataFrame:
    """(var, dims..., location, offset, length): references to source bytes."""
    return ranges.select(F.col(var).alias("var"), *dims, F.col(location).alias("location"), F.col("start").alias("offset"), (F.col("stop") - F.col("start")).alias("length"))


def write_json_index(df: DataFrame, path: str) -> None:
    """JSON lines with their keys in order; NULL fields are left out."""
    df.select(F.to_json(F.struct(*(F.col(f"`{c}`") for c in sorted(df.columns)))).alias("value")).write.text(path)


def references(parts: DataFrame) -> DataFrame:
    """(file, message, offset, length) of `parts` (file, message, length: long): a reference for each message of a file, from its parts in order of messages.

    Offsets run on from part to part. A part of null or negative length ends its file: what
    lies behind it can't be found, so nothing more is referred to.
    """
    along = Window.partitionBy("file").orderBy("message").rowsBetween(Window.unboundedPreceding, 0)
    found = F.coalesce(F.col("length") >= 0, F.lit(False))
    rows = parts.select("file", "message", "length").withColumn("__open", F.min(found).over(along))
    rows = rows.withColumn("offset", F.sum(F.when(F.col("__open"), F.col("length"))).over(along) - F.col("length"))
    return rows.where("__open").select("file", "message", "offset", "length")
