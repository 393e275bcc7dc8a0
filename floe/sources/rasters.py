"""Raster tables: tile and cell readers, and a synthetic pair."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TILE_COLUMNS = {"scene_id", "crs", "ty", "tx", "row0", "col0", "h", "w", "height", "width"}


def read_tiles(spark: SparkSession, path: str, band: str = "values") -> DataFrame:
    """Single-band tile table. Fails when the table lacks tiling columns, or a tile its CRS or cells."""
    tiles = spark.read.parquet(path)
    lacking = (TILE_COLUMNS | {band}) - set(tiles.columns)
    if lacking:
        raise ValueError(f"not a tile table, missing {sorted(lacking)}")
    problem = F.when(F.col("crs").isNull(), "raster without CRS").when(
        F.size(band) != F.col("h") * F.col("w"), "tile with wrong cell count"
    )
    return tiles.withColumn(band, F.when(problem.isNotNull(), F.raise_error(problem)).otherwise(F.col(band)))


def _normal(seed: int, stream: int) -> Column:
    """Standard normal per cell from hashed coordinates: the same on any partitioning."""
    uniform = lambda k: (F.pmod(F.xxhash64("row", "col", F.lit(seed), F.lit(stream), F.lit(k)), F.lit(2**31)) + 0.5) / float(2**31)
    return F.sqrt(-2 * F.log(uniform(0))) * F.cos(2 * math.pi * uniform(1))


def synthetic_pair(spark: SparkSession, height: int, width: int, seed: int, missing_rows: int = 10) -> DataFrame:
    """Test pair in dB: left half equal in both scenes, right half independent, first rows missing."""
    cells = spark.range(height * width).select(
        F.lit(f"synthetic-{seed}").alias("scene_id"),
        F.floor(F.col("id") / width).alias("row"),
        (F.col("id") % width).alias("col"),
        F.lit(height).cast("bigint").alias("height"),
        F.lit(width).cast("bigint").alias("width"),
    )
    level = lambda stream: -15 + 2 * _normal(seed, stream)
    seen = F.col("row") >= missing_rows
    second = F.when(F.col("col") < width // 2, level(0)).otherwise(level(1))
    return cells.withColumns({"a": F.when(seen, level(0)), "b": F.when(seen, second)})
