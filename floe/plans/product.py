"""Pair product: masked texture, segments, classes and extent."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floe.functions.encode import apply_mask, encode_rgb, to_db, validity_code
from floe.functions.geo import cell_area_km2
from floe.operators.cells import cells_to_tiles, downsample_nearest, downsampled_affine, tiles_to_cells
from floe.operators.classify import classify_cells, classify_nearest
from floe.operators.focal import texture_tiles
from floe.operators.masks import mark_cells, rasterize_mask
from floe.operators.metrics import extent_metrics
from floe.operators.superpixels import superpixels
from floe.operators.zonal import segment_features
from floe.schema import MIN_VALID_FRACTION, TEXTURE_WINDOWS, Affine, Grid
from floe.session import durable


@dataclass(frozen=True)
class Settings:
    """Processing choices of a product."""

    widths: tuple[int, ...] = TEXTURE_WINDOWS
    min_fraction: float = MIN_VALID_FRACTION
    tile: int = 512
    units: str = "db"
    downsample: int = 10
    n_segments: int = 1200
    compactness: float = 5.0
    rounds: int = 5
    max_pixels: int | None = None


def grid_edges(edges: DataFrame, grids: DataFrame, on: str = "scene_id") -> DataFrame:
    """Polygon edges with the shape of the grid they mask, matched by region or scene.

    Outlines are clipped per region beforehand, so an edge meets the grids of its own
    region and no other.
    """
    return edges.join(grids.select(on, "height", "width"), on)


def pair_texture(cells: DataFrame, edges: DataFrame, grid: Grid, settings: Settings, mask_key: str = "scene_id") -> DataFrame:
    """Texture cells ``scene_id, row, col, height, width, t1, t2, t3`` of co-registered pairs.

    Exclusion applies before the windows, so masked cells lower the local valid fraction.
    ``edges`` carries the mask key and ``height, width`` besides polygon edges; scenes of
    one region share a mask when the key is the region.
    """
    spans = rasterize_mask(edges, grid.transform, [mask_key])
    marked = mark_cells(cells, spans, [mask_key])
    usable = marked.withColumns({c: apply_mask(to_db(F.col(c), settings.units), F.col("excluded")) for c in ("a", "b")})
    tiles = cells_to_tiles(usable, settings.tile, ["a", "b"])
    bands = [f"t{k}" for k in range(1, len(settings.widths) + 1)]
    textured = tiles_to_cells(texture_tiles(tiles, settings.widths, settings.min_fraction, settings.tile), bands)
    return textured.withColumns({"height": F.lit(grid.height).cast("bigint"), "width": F.lit(grid.width).cast("bigint")})


def segment_grid(textured: DataFrame, edges: DataFrame, grid: Grid, settings: Settings) -> tuple[DataFrame, Affine]:
    """Decimated, colour-encoded, segmented cells with validity, and their transform."""
    affine = downsampled_affine(grid.transform, grid.height, grid.width, settings.downsample)
    # every round below reads these cells again: store the decimated grid, not the texture behind it
    coarse = durable(encode_rgb(downsample_nearest(textured, settings.downsample)).drop("t1", "t2", "t3"))
    segments = superpixels(coarse, settings.n_segments, settings.compactness, settings.rounds, settings.max_pixels)
    small = edges.withColumns({"height": F.ceil(F.col("height") / settings.downsample), "width": F.ceil(F.col("width") / settings.downsample)})
    marked = mark_cells(segments, rasterize_mask(small, affine, ["scene_id"]), ["scene_id"])
    return marked.withColumn("validity", validity_code(F.col("valid"), F.col("excluded"))), affine


def apply_classifier(cells: DataFrame, centres: DataFrame) -> DataFrame:
    """Classes of segmented cells ``scene_id, segment_id, r, g, b, valid, excluded`` by nearest class mean."""
    features = segment_features(cells).withColumnsRenamed({f"mean_{c}": c for c in "rgb"})
    return classify_cells(cells, classify_nearest(features, centres))


def pair_product(cells: DataFrame, edges: DataFrame, grid: Grid, centres: DataFrame, settings: Settings) -> DataFrame:
    """Classified cells with true areas, from raw pair cells to classes in one plan."""
    segmented, affine = segment_grid(pair_texture(cells, edges, grid, settings), edges, grid, settings)
    classified = apply_classifier(segmented, centres)
    return classified.withColumn("area_km2", cell_area_km2("row", "col", affine, grid.crs))


def product_metrics(product: DataFrame) -> DataFrame:
    """Extent, segment count and valid share of each product, from one pass over its cells."""
    segments = F.countDistinct(F.when(F.col("segment_id") > 0, F.col("segment_id"))).alias("segments")
    return extent_metrics(product, ["scene_id"], extra=[segments, F.avg(F.col("valid").cast("int")).alias("valid_fraction")])


def reclassify(cells: DataFrame, centres: DataFrame, affine: Affine) -> DataFrame:
    """New classes and extent for an existing product; its inputs stay untouched."""
    classified = apply_classifier(cells, centres)
    return classified.withColumn("area_km2", cell_area_km2("row", "col", affine))
