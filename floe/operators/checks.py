"""Quality predicates over run tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def numbered(df: DataFrame, time: str, order: list[str]) -> DataFrame:
    """Every row with its ``position`` (from 1) in the order, whose first column is ``time``.

    A row's place within its hour is added to the number of rows of all hours before: one
    window per hour and a running sum over a row per hour, never one task for all rows. An
    hour's size is its last place, so the rows are made once if they have no columns beside the order.
    """
    placed = df.withColumn("_hour", F.date_trunc("hour", time))
    placed = placed.withColumn("_place", F.row_number().over(Window.partitionBy("_hour").orderBy(*order)))
    hours = placed.groupBy("_hour").agg(F.max("_place").alias("_n"))
    before = Window.orderBy(F.asc_nulls_first("_hour")).rowsBetween(Window.unboundedPreceding, -1)
    starts = hours.select(F.col("_hour").alias("_of"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    joined = placed.join(F.broadcast(starts), F.col("_hour").eqNullSafe(F.col("_of")))
    return joined.withColumn("position", (F.col("_start") + F.col("_place")).cast("bigint")).drop("_hour", "_of", "_start", "_place")


def validate_runs(runs: DataFrame) -> DataFrame:
    """Every run with the list of what is wrong with it (empty when sound).

    Columns: ``region, west, south, east, north, start_date, end_date, min_days,
    max_days, min_overlap, polarization, resolution, tile_size, input_units, windows``.
    """
    c = F.col
    windows = c("windows")
    bad = {
        "bbox": ~((c("west") >= -180) & (c("west") < c("east")) & (c("east") <= 180) & (c("south") >= -90) & (c("south") < c("north")) & (c("north") <= 90)),
        "region name": ~c("region").rlike(r"^[\p{L}\p{N}_-]*[\p{L}\p{N}][\p{L}\p{N}_-]*$"),
        "dates": c("end_date") < c("start_date"),
        "baseline": ~((c("min_days") > 0) & (c("min_days") <= c("max_days"))),
        "overlap": ~((c("min_overlap") > 0) & (c("min_overlap") <= 1)),
        "polarization": ~c("polarization").isin("HH", "VV"),
        "grid": (c("resolution") <= 0) | (c("tile_size") < 32),
        "units": ~c("input_units").isin("db", "linear_power"),
        "windows": (F.size(windows) != 3) | F.exists(windows, lambda w: (w < 3) | (w % 2 == 0)),
    }
    reasons = [F.when(F.coalesce(test, F.lit(True)), name) for name, test in bad.items()]
    return runs.withColumn("reasons", F.array_compact(F.array(*reasons)))
