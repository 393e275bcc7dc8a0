"""Training tables from annotated scenes or manual labels, and their assessment."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floe.functions.encode import usable_label
from floe.operators import training
from floe.operators.classify import logo_folds, logo_predictions
from floe.operators.groups import acquisition_groups
from floe.operators.metrics import balanced_accuracy, confusion
from floe.operators.zonal import majority_labels, segment_features
from floe.session import durable


@dataclass(frozen=True)
class Assessment:
    """Leave-one-group-out results of one grouping."""

    folds: DataFrame
    confusion: DataFrame
    accuracy: DataFrame
    unseen: DataFrame


def assess(rows: DataFrame, fold: str) -> Assessment:
    """Hold out every group once; folds that cannot be trained keep their status row."""
    predicted = logo_predictions(rows, fold)
    return Assessment(logo_folds(rows, fold), confusion(predicted, fold), balanced_accuracy(predicted, fold), training.unseen_classes(rows, fold))


def fold_summary(rows: DataFrame, fold: str) -> DataFrame:
    """Sizes, status and balanced accuracy per fold."""
    result = assess(rows, fold)
    return result.folds.join(result.accuracy.select(fold, "balanced_accuracy"), fold, "left")


def train_from_annotations(scenes: DataFrame, cells: DataFrame, annotations: DataFrame, hashes: list[str]) -> DataFrame:
    """Training rows of all scenes at once, each with its region and acquisition group.

    ``scenes``: ``scene_id, region, dates`` and hash columns. Scenes that repeat another
    scene's imagery fail the job, naming both.
    """
    repeated = training.duplicate_scenes(scenes, hashes).filter("scene_id <> first_scene")
    clash = repeated.select("scene_id", F.concat_ws(" and ", F.col("first_scene").cast("string"), F.col("scene_id").cast("string")).alias("clash"))
    features = segment_features(cells).withColumnsRenamed({f"mean_{c}": c for c in "rgb"})
    labelled = training.label_segments(features, annotations)
    grouped = acquisition_groups(scenes).withColumnRenamed("group", "acquisition_group")
    rows = labelled.join(grouped, "scene_id").join(clash, "scene_id", "left")
    refuse = F.raise_error(F.concat(F.lit("duplicate imagery: "), F.col("clash")))
    checked = rows.withColumn("label", F.when(F.col("clash").isNotNull(), refuse).otherwise(F.col("label"))).drop("clash")
    # a few numbers per segment, read by every assessment: store them rather than the cells' aggregation
    return durable(checked)


def train_from_labels(cells: DataFrame, min_purity: float = 0.9) -> DataFrame:
    """Training rows from a manual label grid: ``label, validity, segment_id, r, g, b`` per cell."""
    cleaned = cells.withColumn("label", usable_label(F.col("label"), F.col("validity"), F.col("segment_id")))
    labels = majority_labels(cleaned, min_purity).select("scene_id", "segment_id", "label")
    features = segment_features(cells).withColumnsRenamed({f"mean_{c}": c for c in "rgb"})
    return features.join(labels, ["scene_id", "segment_id"])
