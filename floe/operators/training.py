"""Annotated scenes to a training table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floe.schema import FEATURES, TRAIN_CODES


def explode_annotations(scenes: DataFrame) -> DataFrame:
    """Vectors indexed by segment id to rows; NaN and NULL both mean unlabelled."""
    flat = scenes.select("scene_id", F.posexplode("annotations").alias("segment_id", "label"))
    label = F.when(~F.isnan("label"), F.col("label"))
    return flat.select("scene_id", F.col("segment_id").cast("bigint").alias("segment_id"), label.cast("smallint").alias("label"))


def short_vectors(scenes: DataFrame, segments: DataFrame) -> DataFrame:
    """Scenes whose annotation vector does not reach their largest segment id."""
    largest = segments.groupBy("scene_id").agg(F.max("segment_id").alias("max_id"))
    return (
        scenes.select("scene_id", F.size("annotations").alias("length"))
        .join(largest, "scene_id")
        .filter(F.col("max_id") >= F.col("length"))
    )


def bad_annotations(annotations: DataFrame) -> DataFrame:
    """Labels outside 0, 1, 2, 3."""
    return annotations.filter(F.col("label").isNotNull() & ~F.col("label").isin(0, 1, 2, 3))


def label_segments(features: DataFrame, annotations: DataFrame) -> DataFrame:
    """Segments that occur and carry a trainable label; background and class 1 never train."""
    usable = annotations.filter((F.col("segment_id") > 0) & F.col("label").isin(*TRAIN_CODES))
    return features.join(usable, ["scene_id", "segment_id"])


def unused_annotations(annotations: DataFrame, segments: DataFrame) -> DataFrame:
    """Labelled ids that never occur in the scene's grid (``segments`` may repeat ids)."""
    return annotations.filter(F.col("label").isNotNull()).join(segments, ["scene_id", "segment_id"], "left_anti")


def duplicate_scenes(scenes: DataFrame, hashes: list[str], name: str = "scene_id") -> DataFrame:
    """Scenes that repeat another scene's imagery, each with the first scene of its group.

    Counting is a partial aggregate, so a hash shared by a third of all scenes costs
    one row per task; only repeated hashes come back for the join.
    """
    groups = (
        scenes.groupBy(*hashes)
        .agg(F.min(name).alias("first_scene"), F.count("*").alias("copies"))
        .filter("copies > 1")
    )
    return scenes.select(name, *hashes).join(groups, hashes)


def missing_scenes(requested: DataFrame, available: DataFrame, name: str = "scene_id") -> DataFrame:
    """Requested scenes that are not there."""
    return requested.select(name).distinct().join(available.select(name), name, "left_anti")


def repeated_requests(requested: DataFrame, name: str = "scene_id") -> DataFrame:
    """Names listed more than once; a request list must be unique."""
    return requested.groupBy(name).agg(F.count("*").alias("times")).filter("times > 1")


def training_table(parts: list[DataFrame]) -> DataFrame:
    """Concatenate per-source training tables by column name."""
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return table


def training_regions(scenes: DataFrame) -> DataFrame:
    """Distinct regions, lower case."""
    return scenes.select(F.lower("region").alias("region")).distinct()


def training_report(segments: DataFrame) -> DataFrame:
    """Totals per scene and overall (scene NULL): segments, scenes and counts of each class.

    One row per scene rather than one nested document, so the report scales with the archive.
    """
    count_of = lambda c: F.count(F.when(F.col("label") == c, 1)).alias(f"class_{c}")
    return segments.rollup("scene_id").agg(
        F.count("*").alias("segments"),
        F.countDistinct("scene_id").alias("scenes"),
        *[count_of(c) for c in TRAIN_CODES],
        F.when(F.countDistinct("label") < 2, "needs two classes").alias("problem"),
    )


def unseen_classes(rows: DataFrame, fold: str = "fold") -> DataFrame:
    """Classes that only the fold itself contains: absent from everything outside it.

    A class is unseen when all its rows belong to one fold, which per-fold and total
    counts tell without comparing folds with each other.
    """
    own = rows.groupBy("label", fold).agg(F.count("*").alias("n"))
    total = own.groupBy("label").agg(F.sum("n").alias("total"))
    return own.join(total, "label").filter("n = total").select(fold, "label")


def validate_features(table: DataFrame, columns: tuple[str, ...] = ("r", "g", "b")) -> DataFrame:
    """Soundness of a portable feature table, one row: bad features, bad labels, classes, verdict."""
    finite = F.lit(True)
    for c in columns:
        value = F.col(c).cast("double")
        finite = finite & value.isNotNull() & ~F.isnan(value) & value.between(0, 255)
    good_label = F.coalesce(F.col("label").isin(*TRAIN_CODES), F.lit(False))
    facts = table.agg(
        F.count("*").alias("rows"),
        F.count(F.when(~finite, 1)).alias("bad_features"),
        F.count(F.when(~good_label, 1)).alias("bad_labels"),
        F.countDistinct(F.when(good_label, F.col("label"))).alias("classes"),
    )
    sound = (F.col("bad_features") == 0) & (F.col("bad_labels") == 0) & (F.col("classes") >= 2)
    return facts.withColumns({"sound": sound, "features": F.lit(FEATURES)})
