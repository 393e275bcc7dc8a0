"""Elevation and exclusion-mask preparation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floe.operators.cells import regrid_bilinear
from floe.operators.masks import clip_polygons, mark_cells, rasterize_mask, surface_counts
from floe.operators.terrain import combine_elevation
from floe.schema import Affine


def prepare_elevation(targets: DataFrame, heights: DataFrame, edges: DataFrame, affine: Affine) -> DataFrame:
    """Merged elevation on target cells: bilinear inputs, conservative land mask, geoid on all ocean.

    ``targets`` as for ``regrid_bilinear``; ``heights`` are source cells with ``terrain``
    and ``geoid`` on one grid (bring the coarser one onto the other first); ``edges`` are
    land and shelf polygon edges with the target grid's ``scene_id, height, width``.
    """
    land_at = rasterize_mask(edges, affine, ["scene_id"], all_touched=True)
    regridded = regrid_bilinear(targets, heights, ["terrain", "geoid"])
    return combine_elevation(mark_cells(regridded, land_at, ["scene_id"], "land"))


def prepare_exclusions(polygons: DataFrame, box: tuple[float, float, float, float], margin: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """Clipped exclusion polygons, and counts per surface before selection and after clipping."""
    clipped = clip_polygons(polygons, *box, margin)
    stage = lambda df, name: surface_counts(df).select(F.lit(name).alias("stage"), "surface", "polygons")
    return clipped, stage(polygons, "source").unionByName(stage(clipped, "output"))
