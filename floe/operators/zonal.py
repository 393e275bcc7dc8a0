"""Segments: zonal means, majority labels, counts, painting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floe.schema import TRAIN_CODES

SEGMENT = ["scene_id", "segment_id"]


def segment_features(cells: DataFrame) -> DataFrame:
    """Mean colour per segment; id 0 is background; invalid cells inside a segment count."""
    return (
        cells.filter("segment_id > 0")
        .groupBy(*SEGMENT)
        .agg(*[F.avg(c).alias(f"mean_{c}") for c in "rgb"], F.count("*").alias("cells"))
    )


def majority_labels(cells: DataFrame, min_purity: float = 0.9) -> DataFrame:
    """Label of each segment whose labelled cells agree to at least ``min_purity``.

    Unlabelled cells are not in the denominator; mixed segments are left out.
    """
    votes = (
        cells.filter((F.col("segment_id") > 0) & F.col("label").isin(*TRAIN_CODES))
        .groupBy(*SEGMENT, "label")
        .agg(F.count("*").alias("n"))
    )
    top = votes.groupBy(*SEGMENT).agg(
        F.sum("n").alias("labelled"), F.max(F.struct("n", (-F.col("label")).alias("minus"))).alias("best")
    )
    share = F.col("best.n") / F.col("labelled")
    return top.filter(share >= min_purity).select(
        *SEGMENT, (-F.col("best.minus")).cast("smallint").alias("label"), "labelled", share.alias("purity")
    )


def class_counts(segments: DataFrame, scene: str = "scene_id", label: str = "label") -> DataFrame:
    """Segments per class, per scene and overall (scene NULL), in one pass."""
    counted = segments.rollup(label, scene).agg(F.count("*").alias("segments"), F.grouping(label).alias("all_labels"))
    return counted.filter("all_labels = 0").select(F.col(scene), F.col(label), "segments")


def paint_segments(cells: DataFrame, predictions: DataFrame, column: str = "predicted") -> DataFrame:
    """Segment attribute back to cells; cells without one get NULL."""
    return cells.join(predictions.select(*SEGMENT, column), SEGMENT, "left")


def valid_fraction(cells: DataFrame, valid: Column, keys: list[str]) -> DataFrame:
    """Share of valid cells over all grid cells."""
    return cells.groupBy(*keys).agg(F.avg(valid.cast("int")).alias("valid_fraction"))


def segment_count(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct segments, background excluded; scenes with none report 0."""
    real = F.when(F.col("segment_id") > 0, F.col("segment_id"))
    return cells.groupBy(*keys).agg(F.countDistinct(real).alias("segments"))


def paint_masks(masks: DataFrame, cell: list[str], area: str = "area", mask: str = "mask_id") -> DataFrame:
    """Overlapping masks to one owner per cell: smaller area wins, then the later mask.

    A partial aggregate per cell, so no cell's masks are ever sorted or collected.
    """
    rank = F.struct((-F.col(area)).alias("small"), F.col(mask).alias("mask"))
    return masks.groupBy(*cell).agg(F.max(rank).alias("owner")).select(*cell, F.col("owner.mask").alias(mask))
