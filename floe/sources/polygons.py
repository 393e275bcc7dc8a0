"""Exclusion polygons from GeoJSON features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floe.functions import rings
from floe.operators.masks import refuse_crossing
from floe.schema import SURFACES

# Polygon feature layout.
FEATURE = "struct<properties: struct<poly_id: bigint, surface: string>, geometry: struct<type: string, coordinates: string>>"
_POLYGON, _MULTI = "array<array<array<double>>>", "array<array<array<array<double>>>>"


def parse_polygons(lines: DataFrame, column: str = "json", identity: Column | None = None) -> DataFrame:
    """Polygon and MultiPolygon features to one row per ring: ``poly_id, part, ring_no, surface, ring``.

    Only land and floating-ice surfaces are kept; lines and points are not polygons and fail. A polygon's rings are
    read by the even-odd rule, so two features must never share an id: ``identity`` names each line where files do not
    number theirs reliably. Without it the file's number counts, else the content, and equal features are one.
    """
    carried = [] if identity is None else [identity.alias("_identity")]
    parsed = lines.select(*carried, F.explode(F.array(F.from_json(column, FEATURE))).alias("f")).filter(F.col("f.properties.surface").isin(*SURFACES))
    kind, text = F.col("f.geometry.type"), F.col("f.geometry.coordinates")
    wrong = F.raise_error(F.concat(F.lit("not a polygon: "), F.coalesce(kind, F.lit("no geometry"))))
    parts = (
        F.when(kind == "Polygon", F.array(F.from_json(text, _POLYGON)))
        .when(kind == "MultiPolygon", F.from_json(text, _MULTI))
        .otherwise(wrong)
    )
    if identity is None:
        # a feature listed twice covers what it covers once
        parsed = parsed.dropDuplicates(["f"])
        poly_id = F.coalesce("f.properties.poly_id", F.xxhash64("f.properties.surface", kind, text))
    else:
        poly_id = F.col("_identity")
    part = parsed.select(poly_id.alias("poly_id"), "f.properties.surface", F.posexplode(parts).alias("part", "rings"))
    ring = part.select("poly_id", "surface", "part", F.posexplode("rings").alias("ring_no", "points"))
    points = F.transform("points", lambda xy: F.struct(xy[0].alias("x"), xy[1].alias("y")))
    opened = ring.select("poly_id", "part", "ring_no", "surface", rings.open_ring(points).alias("ring"))
    return refuse_crossing(opened)


def rings_from_vertices(vertices: DataFrame, keys: list[str]) -> DataFrame:
    """Vertex rows ``seq, x, y`` to one ring per key (one ring is one polygon's outline)."""
    point = F.struct("seq", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    packed = vertices.groupBy(*keys).agg(F.array_sort(F.collect_list(point)).alias("points"))
    ring = F.transform("points", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
    return packed.select(*keys, ring.alias("ring"))


LONLAT, POLAR = "OGC:CRS84", "EPSG:3031"


def file_crs(name: Column) -> Column:
    """The reference system a file names; none means longitude and latitude."""
    code = F.regexp_extract(name, r"EPSG:+(?:[0-9.]*:)?(\d+)$", 1)
    known = F.when(name.isNull() | name.endswith("CRS84") | (code == "4326"), LONLAT).when(code == "3031", POLAR)
    return F.coalesce(known, F.raise_error(F.concat(F.lit("unknown reference system: "), name)))


def read_polygons(spark, path: str | None) -> DataFrame:
    """GeoJSON files under a path, with the ``crs`` of each ring; no path means no polygon at all, but a file without any fails.

    A feature is known by its file and its place in it, whatever number it carries.
    """
    empty = "poly_id bigint, part int, ring_no int, surface string, ring array<struct<x:double,y:double>>, crs string"
    if path is None:
        return spark.createDataFrame([], empty)
    layout = f"crs struct<properties: struct<name: string>>, features array<{FEATURE}>"
    documents = spark.read.schema(layout).option("multiLine", True).json(path)
    crs = file_crs(F.col("crs.properties.name")).alias("crs")
    features = documents.select(F.col("_metadata.file_path").alias("file"), crs, F.posexplode("features").alias("place", "f"))
    named = features.select(F.xxhash64("file", "place").alias("id"), "crs", F.to_json("f").alias("json"))
    polygons = parse_polygons(named, identity=F.col("id"))
    if polygons.isEmpty():
        raise ValueError("no land or shelf polygon found")
    return polygons.join(named.select(F.col("id").alias("poly_id"), "crs"), "poly_id")


def on_map(polygons: DataFrame) -> DataFrame:
    """Rings on the polar map: longitudes and latitudes are projected, map metres stay. Clip before, in the file's own plane."""
    ring = F.when(F.col("crs") == LONLAT, rings.project_ring(F.col("ring"))).otherwise(F.col("ring"))
    return polygons.withColumns({"ring": ring, "crs": F.lit(POLAR)})
