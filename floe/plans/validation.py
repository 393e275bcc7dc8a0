"""Outline validation on a reviewed domain."""

from __future__ import annotations

from pyspark.sql import DataFrame

from floe.functions.geo import cell_area_km2
from floe.operators.masks import mark_cells, rasterize_mask
from floe.operators.metrics import outline_assessment, overlay
from floe.schema import Affine


def validate_outline(cells: DataFrame, domain: DataFrame, reference: DataFrame, mask_affine: Affine, area_affine: Affine | None = None) -> DataFrame:
    """Area-weighted assessment per scene of ``scene_id, row, col, cls, validity`` cells.

    ``domain`` and ``reference`` are polygon edges with ``scene_id, height, width``.
    Outlines may be drawn in other units than metres; areas always come from the map.
    """
    in_domain = mark_cells(cells, rasterize_mask(domain, mask_affine, ["scene_id"]), ["scene_id"], "in_domain")
    marked = mark_cells(in_domain, rasterize_mask(reference, mask_affine, ["scene_id"]), ["scene_id"], "in_reference")
    area = cell_area_km2("row", "col", area_affine or mask_affine)
    return outline_assessment(overlay(marked.withColumn("area_km2", area)), ["scene_id"])
