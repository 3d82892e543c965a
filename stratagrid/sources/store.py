"""Published tables: Parquet folders partitioned by region, written by Spark's own committer.

What the guards ask for is observed while the rows are written to a table beside the
published one; then a publication writes the regions it has (dynamic partition
overwrite), replicas before the primary, from the same rows. Snapshots, expiry and concurrent writers are
a table format's work: to have them, use a catalog table of such a format as the target.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class GuardError(ValueError):
    """A publication would lose or change what is published."""


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table was written at `path`."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read(spark: SparkSession, root: str) -> DataFrame | None:
    """The published rows; None before the first publication. Filters on the region prune partitions."""
    return spark.read.parquet(root) if exists(spark, root) else None


def drift(published: T.StructType, new: T.StructType) -> list[str]:
    """Columns that are gone or changed type; new columns are allowed."""
    have = {f.name: f.dataType.simpleString() for f in new.fields}
    return [f"{f.name}: {f.dataType.simpleString()} became {have.get(f.name, 'missing')}" for f in published.fields if have.get(f.name) != f.dataType.simpleString()]


def extent_of(table: DataFrame | None, region: str, extent: str):
    """The largest published position; only the last region is read."""
    if table is None:
        return None
    last = table.agg(F.max(region)).first()[0]
    return table.where(F.col(region) == last).agg(F.max(extent)).first()[0]


def guard(n: int, reach, schema: T.StructType, published: DataFrame | None, region: str, extent: str, may_shrink: bool = False, only_regions: bool = False) -> None:
    """Raise if nothing is to be published (`n` rows up to `reach`), a published column is lost or changes type, or the largest `extent` shrinks."""
    if not n:
        raise GuardError("an empty table is not published")
    if published is None:
        return
    if changed := drift(published.drop(region).schema, schema):  # the region's type is read from folder names
        raise GuardError("; ".join(changed))
    if not only_regions and not may_shrink and reach < extent_of(published, region, extent):
        raise GuardError("the published extent would shrink")


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def publish(df: DataFrame, roots: list[str], region: str, extent: str, may_shrink: bool = False, only_regions: bool = False, salt: Column | None = None) -> None:
    """Write `df` to `roots`, the primary first in the list and last in time.

    With `only_regions` the regions of `df` replace their like and the others stay as
    they are; else `df` is all there is. `df` is evaluated once, into a table in the
    shared folder, while the write observes what the guards ask for; the guards are
    checked against the primary, and all roots get the written rows. Regions are
    replaced by dynamic partition overwrite, which keeps the old ones until the new ones
    are whole, and regions that are gone are deleted last: a failed job leaves what was
    published. A region is written by one task, or with `salt` (a small integer of a
    row) by as many as that has values. A published table may be an input of `df`.
    """
    spark = df.sparkSession
    seen = Observation("publication")
    staged_at = f"{shared_dir(spark)}/publication-{uuid.uuid4().hex}"
    salted = df.withColumn("__salt", salt) if salt is not None else df
    try:
        salted.observe(seen, F.count(F.lit(1)).alias("n"), F.max(extent).alias("reach")).write.parquet(staged_at)
        guard(seen.get["n"], seen.get.get("reach"), df.schema, read(spark, roots[0]), region, extent, may_shrink, only_regions)
        staged = spark.read.schema(salted.schema).parquet(staged_at)
        rows = staged.repartition(F.col(region), *([F.col("__salt")] if salt is not None else [])).select(*df.columns)
        for root in [*roots[1:], roots[0]]:
            gone = [] if only_regions or not exists(spark, root) else _regions(spark, root, region) - _regions_of(staged, region)
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(region).parquet(root)
            for name in gone:
                _delete(spark, f"{root}/{name}")
    finally:
        _delete(spark, staged_at)


def _regions(spark: SparkSession, root: str, region: str) -> set[str]:
    """The names of the folders of a table's regions."""
    p = spark._jvm.org.apache.hadoop.fs.Path(root)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)
    return {n for n in (f.getPath().getName() for f in found) if n.startswith(f"{region}=")}


def _regions_of(rows: DataFrame, region: str) -> set[str]:
    """The names that the regions of `rows` get, one each."""
    values = rows.select(F.col(region).cast("string")).distinct().collect()
    return {f"{region}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for (v,) in values}


def resume_point(spark: SparkSession, root: str, region: str, extent: str, start):
    """Where an update begins: the largest published position, which it does again; `start` for a new store."""
    reach = extent_of(read(spark, root), region, extent)
    return start if reach is None else reach


def merged(tables: list[DataFrame]) -> DataFrame:
    """Groups of one table as one relation; columns that a group lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, the folder that driver and executors share; a local session without it gets a folder of its own."""
    where = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if where is None:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        where = tempfile.mkdtemp(prefix="stratagrid-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where


def written(df: DataFrame, name: str) -> DataFrame:
    """`df`, written once to a new table in the shared folder and read back, which cuts its lineage."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
