"""Validation: each check is a relation (check, passed, message, checked)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import stats
from .series import due_position, recency_tier


def _result(df: DataFrame, name: str, passed: Column, message: Column, checked: Column) -> DataFrame:
    return df.select(F.lit(name).alias("check"), F.coalesce(passed, F.lit(False)).alias("passed"), message.alias("message"), F.coalesce(checked, F.lit(0)).cast("long").alias("checked"))


def current_data(df: DataFrame, position: str, first: int, every: int, delay: int, now: int) -> DataFrame:
    """The newest due position is present."""
    due = due_position(F.lit(now), F.lit(first), every, delay)
    g = df.agg(F.max(F.when(F.col(position) == due, 1)).alias("hit"), F.max(position).alias("last"), F.count("*").alias("n"))
    return _result(g, "current_data", F.col("hit") == 1, F.concat_ws(" ", F.lit("newest"), F.col("last").cast("string"), F.lit("due"), due.cast("string")), F.col("n"))


def recent_missing(df: DataFrame, position: str, value: str, tiers: list[float], window: int | None = None, sampled: int | None = None, seed: int = 0, no_hour_0: Column | None = None) -> DataFrame:
    """Of the newest `window` positions (as many as tiers, if not given) none misses more than its tier allows; the last tier extends.

    Fewer positions than tiers fail. A tier of 1 allows everything, and its positions
    aren't checked. With `sampled` only so many of the window, drawn by a hash of seed
    and position, are. Cells where `no_hour_0` holds (the first lead of variables that
    have no value there) don't count.
    """
    n = max(window or 0, len(tiers))
    cells = df if no_hour_0 is None else df.withColumn(value, F.when(~F.coalesce(no_hour_0, F.lit(False)), F.struct(F.col(value).alias("v"))).alias(value))
    if no_hour_0 is not None:  # positions stay, cells go
        by = cells.groupBy(position).agg(F.count(value).alias("n"), F.count_if(F.col(value).isNotNull() & (F.col(f"{value}.v").isNull() | F.isnan(F.col(f"{value}.v").cast("double")))).alias("n_missing"))
        by = by.withColumn("fraction", F.coalesce(F.try_divide("n_missing", "n"), F.lit(0.0)))
    else:
        by = stats.null_fraction(cells, [position], value)
    t = recency_tier(by.orderBy(F.desc(position)).limit(n), position, tiers)
    if sampled is not None:
        drawn = F.row_number().over(Window.orderBy(F.md5(F.concat_ws(":", F.lit(seed), F.col(position))), F.desc(position)))  # of a window of positions
        t = t.withColumn("__drawn", drawn <= sampled)
    else:
        t = t.withColumn("__drawn", F.lit(True))
    checked = F.col("__drawn") & (F.col("limit") < 1) if sampled is not None or window is not None else F.lit(True)
    bad = F.count_if(F.col("__drawn") & (F.col("limit") < 1) & (F.col("fraction") > F.col("limit")))
    g = t.agg(bad.alias("bad"), F.count("*").alias("have"), F.count_if(checked).alias("n"))
    return _result(g, "recent_missing", (F.col("bad") == 0) & (F.col("have") >= len(tiers)), F.concat(F.col("bad").cast("string"), F.lit(" positions over their limit")), F.col("n"))


def complete(by_position: DataFrame, position: str, tiers: list[float]) -> DataFrame:
    """The newest positions have the share their tier asks for, and older ones the last tier's, which is 1."""
    if tiers[-1] != 1.0:
        raise ValueError("the last tier is 1")
    newest = recency_tier(by_position.orderBy(F.desc(position)).limit(len(tiers)), position, tiers).select(position, "limit")
    t = by_position.join(newest, position, "left").withColumn("limit", F.coalesce("limit", F.lit(1.0)))
    g = t.agg(F.count_if(F.col("ratio") < F.col("limit")).alias("bad"), F.count("*").alias("n"))
    return _result(g, "complete", (F.col("bad") == 0) & (F.col("n") > 0), F.concat(F.col("bad").cast("string"), F.lit(" incomplete positions")), F.col("n"))


def no_rows(df: DataFrame, name: str, checked: int | Column = 0) -> DataFrame:
    """Passes if a relation of faults is empty."""
    g = df.agg(F.count("*").alias("n"))
    return _result(g, name, F.col("n") == 0, F.concat(F.col("n").cast("string"), F.lit(" faults")), F.lit(checked) if isinstance(checked, int) else checked)


def decoded(samples: DataFrame, value: str, error: str) -> DataFrame:
    """Samples decode: none fails, not all are missing, and there are some."""
    g = samples.agg(F.count(error).alias("errors"), F.count(value).alias("values"), F.count("*").alias("n"))
    return _result(g, "decoded", (F.col("errors") == 0) & (F.col("values") > 0), F.concat(F.col("errors").cast("string"), F.lit(" errors")), F.col("n"))


def metadata_faults(decoded: DataFrame, expected: DataFrame, var: str = "var") -> DataFrame:
    """(var, fault) of messages whose element, comment or description isn't what their variable's are.

    expected: (var, element, comment, description, unit_only, categorical). With
    unit_only only the unit in brackets of the comment counts, and the description not
    at all; the comment of a categorical variable is compared by 100 characters.
    """
    e = expected.select(var, *(F.col(c).alias(f"__{c}") for c in ("element", "comment", "description", "unit_only", "categorical")))
    unit = lambda c: F.regexp_extract(c, r"\[.*$", 0)
    comment = F.when(F.col("__unit_only"), unit("comment") == unit("__comment")).when(F.col("__categorical"), F.left("comment", F.lit(100)) == F.left("__comment", F.lit(100))).otherwise(F.col("comment").eqNullSafe(F.col("__comment")))
    ways = {"element": F.col("element").eqNullSafe(F.col("__element")), "comment": comment, "description": F.col("__unit_only") | F.col("description").eqNullSafe(F.col("__description"))}
    faults = F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in ways.items())))
    return decoded.join(e, var).select(var, F.explode(faults).alias("fault"))


def report(results: list[DataFrame]) -> DataFrame:
    """All results, and whether any failed as `fingerprint` (8 hexadecimal digits of the failed checks' names)."""
    every = reduce(DataFrame.union, results)
    failed = every.agg(F.substring(F.sha2(F.concat_ws(",", F.array_sort(F.collect_list(F.when(~F.col("passed"), F.col("check"))))), 256), 1, 8).alias("fingerprint"))
    return every.join(F.broadcast(failed))  # one row


def strictly_selected(names: list[str], include: list[str] | None, exclude: list[str]) -> list[str]:
    """`include` (or all) less `exclude`, in catalogue order; unknown names and an empty choice are errors."""
    unknown = sorted({*(include or []), *exclude} - set(names))
    chosen = [n for n in names if (include is None or n in include) and n not in exclude]
    if unknown or not chosen:
        raise ValueError(f"unknown variables: {unknown}" if unknown else "no variables are left")
    return chosen


def markdown(results: DataFrame) -> DataFrame:
    """Lines of a table of results, failures first; `order` sorts them."""
    flag = F.when(F.col("passed"), "passed").otherwise("FAILED")
    rows = results.select(F.struct(F.lit(1), F.col("passed"), F.col("check")).alias("order"), F.concat(F.lit("| "), F.concat_ws(" | ", "check", flag, F.regexp_replace("message", "\\|", "/"), F.col("checked").cast("string")), F.lit(" |")).alias("line"))
    head = results.sparkSession.createDataFrame([(0, "| check | result | message | checked |"), (1, "| --- | --- | --- | --- |")], "n int, line string")
    return head.select(F.struct(F.lit(0), (F.col("n") > 0), F.col("line").alias("check")).alias("order"), "line").union(rows)
