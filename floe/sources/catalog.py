"""Scene catalogues: GeoJSON feature collections to a flat scene table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from floe.functions.rings import meets_box, open_ring
from floe.operators.pairs import capped

BOX = ("west", "south", "east", "north")

# Property names of the provider's features.
FEATURE = """struct<
  geometry: struct<type: string, coordinates: array<array<array<double>>>>,
  properties: struct<fileID: string, fileName: string, sceneName: string, startTime: string,
    stopTime: string, platform: string, pathNumber: bigint, flightDirection: string,
    beamModeType: string, polarization: string, processingLevel: string, url: string>>"""


def _time(value: Column) -> Column:
    """ISO text to an instant; a missing zone means UTC."""
    return F.to_timestamp(value)


def flatten_features(features: DataFrame, column: str = "feature") -> DataFrame:
    """Feature structs to scenes; the footprint is the polygon's outer ring."""
    p = lambda name: F.col(f"{column}.properties.{name}")
    outer = F.try_element_at(F.col(f"{column}.geometry.coordinates"), F.lit(1))
    ring = F.transform(outer, lambda xy: F.struct(xy[0].alias("x"), xy[1].alias("y")))
    base_name = F.substring_index(F.substring_index(p("url"), "?", 1), "/", -1)
    name = F.coalesce(p("sceneName"), base_name)
    return features.select(
        F.coalesce(p("fileID"), p("fileName")).alias("file_id"),
        p("fileName").alias("file_name"),
        _time(p("startTime")).alias("start_time"),
        _time(p("stopTime")).alias("stop_time"),
        p("platform").alias("platform"),
        F.substring(name, 1, 3).alias("mission"),
        p("pathNumber").alias("path_number"),
        p("flightDirection").alias("flight_direction"),
        p("beamModeType").alias("beam_mode"),
        p("polarization").alias("polarization"),
        p("processingLevel").alias("processing_level"),
        p("url").alias("url"),
        ring.alias("footprint"),
    )


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Feature collections under a path, one document per file."""
    documents = spark.read.schema(f"features array<{FEATURE}>").option("multiLine", True).json(path)
    return flatten_features(documents.select(F.explode("features").alias("feature")))


def parse_features(lines: DataFrame, column: str = "json") -> DataFrame:
    """One feature per row as JSON text (a catalogue exported line by line)."""
    # behind a generator, so that each line is parsed once and not once per column
    parsed = F.explode(F.array(F.from_json(column, FEATURE)))
    return flatten_features(lines.select(parsed.alias("feature")))


def _bounds(ring: Column) -> dict[str, Column]:
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return dict(zip(BOX, (F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys))))


def store_catalog(scenes: DataFrame, path: str, step: float = 5.0) -> None:
    """Write scenes with the box of each footprint, one folder a month, rows in the order of squares of ``step`` degrees and time.

    A search then reads the months of its dates and, by the least and largest box values that the files keep for each row group,
    the squares near its area. Files are cut by ranges of that order, so a busy month or square is spread over many. Scenes
    without a start time or footprint are stored as well (month or box null); box columns of their own are replaced.
    """
    square = lambda c: F.floor(F.col(c) / step)
    boxed = scenes.drop(*BOX, "month").withColumns(_bounds(F.col("footprint"))).withColumn("month", F.date_format("start_time", "yyyy-MM"))
    order = [F.col("month"), square("south"), square("west"), F.col("start_time")]
    boxed.repartitionByRange(*order).sortWithinPartitions(*order).write.partitionBy("month").parquet(path)


def stored_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Scenes written by ``store_catalog``; months stay text."""
    schema = spark.read.parquet(path).schema
    schema["month"].dataType = T.StringType()
    return spark.read.schema(schema).parquet(path)


def search_catalog(
    scenes: DataFrame,
    aoi: tuple[float, float, float, float],
    start_date: str,
    end_date: str,
    beam_modes: list[str],
    levels: list[str],
    platform: str = "Sentinel-1",
    max_results: int | None = None,
) -> DataFrame:
    """Scenes of a request: footprint meets the area, dates through 23:59:59 of the last day, mode and level lists.

    The footprint's box is compared first and then the ring itself, so a tilted footprint beside the area is not
    returned. Of a stored catalogue the box and month are columns, and both filters reach the scan.
    ``possibly_truncated`` is true when the result reached ``max_results``; without a
    cap it is false and the result stays fully distributed.
    """
    west, south, east, north = aoi
    if {*BOX, "month"} <= set(scenes.columns):
        bounds = {c: F.col(c) for c in BOX}
        scenes = scenes.filter(F.col("month").between(start_date[:7], end_date[:7]))
    else:
        bounds = _bounds(F.col("footprint"))
    found = scenes.filter(
        F.col("platform").startswith(platform)
        & F.col("start_time").between(F.to_timestamp(F.lit(start_date)), F.to_timestamp(F.lit(f"{end_date} 23:59:59")))
        & F.col("beam_mode").isin(*beam_modes)
        & F.col("processing_level").isin(*levels)
        & (bounds["east"] >= west)
        & (bounds["west"] <= east)
        & (bounds["north"] >= south)
        & (bounds["south"] <= north)
    ).filter(meets_box(open_ring(F.col("footprint")), west, south, east, north))
    if max_results is None:
        return found.withColumn("possibly_truncated", F.lit(False))
    return capped(found, ["start_time", "file_id"], max_results)
