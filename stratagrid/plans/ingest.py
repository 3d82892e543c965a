"""The lifecycle of a dataset: backfill, update, and what is left to do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import align
from ..sources import store
from .spec import Dataset, transform_all


def region_of(dataset: Dataset, position: Column) -> Column:
    return F.floor((position - dataset.first) / (dataset.every * dataset.region))


def transformed(cells: DataFrame, dataset: Dataset, gap: str | None = None) -> DataFrame:
    """Source cells (keys, append dimension, var, value) as they are published, with their region."""
    done = transform_all(cells, dataset, dataset.append, gap, region_of(dataset, F.col(dataset.append)))
    return done.select(*dataset.keys, dataset.append, "var", "value").withColumn("region", region_of(dataset, F.col(dataset.append)))


def backfill(cells: DataFrame, dataset: Dataset, roots: list[str], start: int | None = None, end: int | None = None) -> None:
    """Publish all positions from start (inclusive) to end (exclusive), in whole regions."""
    if end is not None:
        cells = cells.where(F.col(dataset.append) < end)
    region = max(0, start - dataset.first) // (dataset.every * dataset.region) if start is not None else None
    store.publish(transformed(cells, dataset) if region is None else from_region(cells, dataset, region), roots, "region", dataset.append)


def handed_on(cells: DataFrame, dataset: Dataset, begin: int, halo: int | None = None) -> DataFrame:
    """Of each series with cells from `begin` on its last cell before it, however far back.

    The `halo` positions before (a region's, if not given) are looked at first, and 16
    times as far for what is still lacking, so that the past is read only as far as a
    series' own gap reaches.
    """
    at, on = F.col(dataset.append), [*dataset.keys, "var"]
    wanted = cells.where(at >= begin).select(*on).distinct()
    found = cells.where(F.lit(False))
    hi, reach = begin, max(1, halo or dataset.region) * dataset.every
    last = F.max(F.struct(F.col(dataset.append), *(F.col(c) for c in cells.columns if c not in (dataset.append, *on)))).alias("__last")
    while True:
        lo = begin - reach
        near = cells.where(at < hi)
        if lo > dataset.first:
            near = near.where(at >= lo)
        got = near.join(wanted, on, "left_semi").groupBy(*on).agg(last)
        found = found.unionByName(got.select(*on, "__last.*"))
        if lo <= dataset.first:
            return found
        wanted = wanted.join(got, on, "left_anti")
        if wanted.isEmpty():
            return found
        hi, reach = lo, 16 * reach


def from_region(cells: DataFrame, dataset: Dataset, region: int, halo: int | None = None) -> DataFrame:
    """The transformed cells of `region` and later ones, as if all before had been transformed too."""
    begin = dataset.first + region * dataset.region * dataset.every
    recent = cells.where(F.col(dataset.append) >= begin)
    if begin > dataset.first and any(v.rate for v in dataset.variables):
        rates = F.col("var").isin([v.name for v in dataset.variables if v.rate])
        recent = recent.unionByName(handed_on(cells.where(rates), dataset, begin, halo))
    return transformed(recent, dataset).where(F.col("region") >= region)


def backfill_range(dataset: Dataset, now: int, last: int | None, may_overwrite: bool = False) -> tuple[int, int]:
    """(start, end) of a backfill: up to now for a new store; of an existing one what it holds, if that may be overwritten."""
    if last is None:
        return dataset.first, now // dataset.every * dataset.every
    if not may_overwrite:
        raise store.GuardError("the store exists")
    return dataset.first, last + dataset.every


def update(cells: DataFrame, dataset: Dataset, roots: list[str], halo: int | None = None, window: int = 0) -> None:
    """Publish what is new: from the region `window` before the last published position on.

    Those regions are done again, because late sources may have come. The first region
    gets the last cell of each series before it (`handed_on`, which looks at
    `halo` positions first), so that the result is a backfill's. Regions before it aren't written, and
    no source is read from them but what a gap reaches back to.
    """
    last = store.resume_point(cells.sparkSession, roots[0], "region", dataset.append, None)
    if last is None:
        return backfill(cells, dataset, roots)
    region = max(0, last - window - dataset.first) // (dataset.every * dataset.region)
    store.publish(from_region(cells, dataset, region, halo), roots, "region", dataset.append, only_regions=True)


def trimmed(cells: DataFrame, results: DataFrame, append: str, region_start) -> DataFrame:
    """`cells` up to the newest position that any variable's source succeeded at; before the region, if none did.

    results: (append, status) of source files, status "succeeded" or another. A variable
    may have holes before that position.
    """
    reach = results.where("status = 'succeeded'").agg(F.max(append).alias("__reach"))
    kept = cells.join(F.broadcast(reach))  # one row
    within = F.coalesce(F.col(append) <= F.col("__reach"), F.col(append) < F.lit(region_start))
    return kept.where(within).drop("__reach")


def pending_files(wanted: DataFrame, dataset: Dataset, root: str, representative: str) -> DataFrame:
    """Wanted source files (file, var, keys, append dimension; `representative` marks one row a file) without published cells."""
    spark: SparkSession = wanted.sparkSession
    have = store.read(spark, root)
    if have is None:
        return wanted.select("file").distinct()
    on = [*dataset.keys, dataset.append, "var"]
    return align.missing(wanted.where(representative), have.where("value is not null"), on).select("file").distinct()
