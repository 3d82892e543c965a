"""Layout advice: chunk and shard shapes of a grid, enumerated and scored as a relation.

The candidates of a grid are a few thousand rows made from its divisors.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes of a value, assumed compression, and compressed sizes in MB (range, best).
BYTES, COMPRESSION = 4, 0.2
CHUNK_MB, CHUNK_BEST_MB = (2.5, 6.0), 3.5
SHARD_MB, SHARD_BEST_MB = (100.0, 1200.0), 300.0


def sizes(n: int) -> list[int]:
    """Tile sizes of an axis: those that need a different number of tiles, smallest first."""
    return sorted({-(-n // k) for k in range(1, n + 1)})


def _product(spark: SparkSession, options: dict[str, list[int]]) -> DataFrame:
    frames = [spark.createDataFrame([(x,) for x in v], f"`{k}` long") for k, v in options.items()]
    return reduce(DataFrame.crossJoin, frames)


def _megabytes(dims: list[str]) -> Column:
    return reduce(lambda a, b: a * b, [F.col(d) for d in dims]).cast("double") * (BYTES * COMPRESSION / 1e6)


def evenness(n: int, size: Column) -> Column:
    """1 less the variation of the tiles' sizes along an axis of n."""
    tiles = F.ceil(n / size)
    last = n - (tiles - 1) * size
    mean = F.lit(float(n)) / tiles
    variance = ((tiles - 1) * F.pow(size - mean, F.lit(2)) + F.pow(last - mean, F.lit(2))) / tiles
    return 1 - F.sqrt(variance) / mean


def chunk_shapes(spark: SparkSession, shape: dict[str, int], square: tuple[str, str] | None = None, most: int = 20) -> DataFrame:
    """The best chunk shapes: 0.3 size + 0.4 evenness + 0.3 squareness."""
    dims = list(shape)
    df = _product(spark, {d: sizes(n) for d, n in shape.items()}).withColumn("mb", _megabytes(dims)).where(F.col("mb").between(*CHUNK_MB))
    size = 1 - F.abs(F.col("mb") - CHUNK_BEST_MB) / CHUNK_BEST_MB
    even = reduce(lambda a, b: a + b, [evenness(n, F.col(d)) for d, n in shape.items()]) / len(dims)
    side = F.least(*(F.col(d) for d in square)) / F.greatest(*(F.col(d) for d in square)) if square else F.lit(1.0)
    return df.withColumn("score", F.round(0.3 * size + 0.4 * even + 0.3 * side, 9)).orderBy(F.desc("score"), *dims).limit(most)


def shard_shapes(spark: SparkSession, shape: dict[str, int], chunk: dict[str, int], square: tuple[str, str] | None = None, most: int = 10) -> DataFrame:
    """The best shard shapes, multiples of the chunk: 0.25 size + 0.45 evenness + 0.30 squareness."""
    dims = list(shape)
    multiples = {d: [chunk[d] * k for k in range(1, -(-n // chunk[d]) + 1)] for d, n in shape.items()}
    df = _product(spark, multiples).withColumn("mb", _megabytes(dims)).where(F.col("mb").between(*SHARD_MB))
    size = 1 - F.abs(F.col("mb") - SHARD_BEST_MB) / SHARD_MB[1]
    even = reduce(lambda a, b: a + b, [evenness(n, F.least(F.col(d), F.lit(n))) for d, n in shape.items()]) / len(dims)
    side = F.least(*(F.col(d) for d in square)) / F.greatest(*(F.col(d) for d in square)) if square else F.lit(1.0)
    return df.withColumn("score", F.round(0.25 * size + 0.45 * even + 0.30 * side, 9)).orderBy(F.desc("score"), *dims).limit(most)


def access_cost(chunks: DataFrame, shape: dict[str, int], space: tuple[str, str], time: str) -> DataFrame:
    """MB read for one time step of the whole grid and for all steps of one point."""
    y, x = space
    slice_ = F.ceil(shape[y] / F.col(y)) * F.ceil(shape[x] / F.col(x)) * F.col("mb")
    return chunks.withColumns({"slice_mb": slice_, "series_mb": F.ceil(shape[time] / F.col(time)) * F.col("mb")})
