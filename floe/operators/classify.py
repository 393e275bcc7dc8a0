"""Segment classifiers: nearest centroid in pure column maths, random forest from pyspark.ml."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floe.functions.encode import final_class
from floe.operators.zonal import paint_segments
from floe.schema import TRAIN_CODES

FEATURE_COLUMNS = ("r", "g", "b")


def class_sums(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Per key and label: row count and feature sums, all a centroid needs."""
    return rows.groupBy(*keys, "label").agg(
        F.count("*").alias("n"), *[F.sum(F.col(c).cast("double")).alias(f"sum_{c}") for c in FEATURE_COLUMNS]
    )


def centroids(rows: DataFrame) -> DataFrame:
    """Mean colour per class."""
    return class_sums(rows, []).select("label", *[(F.col(f"sum_{c}") / F.col("n")).alias(c) for c in FEATURE_COLUMNS])


def _nearest(model: Column) -> Column:
    """Label of the closest centre in ``array<struct<label, r, g, b>>``; ties go to the smaller code.

    Distances are rounded so that a tie is a tie whatever the order of summation.
    """

    def scored(centre: Column) -> Column:
        distance = F.lit(0.0)
        for c in FEATURE_COLUMNS:
            distance = distance + F.pow(F.col(c) - centre[c], F.lit(2.0))
        return F.struct(F.round(distance, 6).alias("distance"), centre["label"].alias("label"))

    return F.array_min(F.transform(model, scored))["label"]


def classify_nearest(rows: DataFrame, centres: DataFrame, out: str = "predicted") -> DataFrame:
    """Nearest-centroid label for rows with r, g, b; the model is one value of at most three entries."""
    centre = F.struct("label", *FEATURE_COLUMNS)
    model = centres.filter(F.col("label").isin(*TRAIN_CODES)).agg(F.collect_list(centre).alias("model"))
    return rows.withColumn("_model", model.scalar()).withColumn(out, _nearest(F.col("_model"))).drop("_model")


def fold_statistics(rows: DataFrame, fold: str = "fold") -> DataFrame:
    """Training sums of every fold by subtraction: total minus the fold's own rows.

    One aggregate serves all folds; nothing is repeated per fold.
    """
    own = class_sums(rows, [fold])
    sums = ["n", *[f"sum_{c}" for c in FEATURE_COLUMNS]]
    per_fold = own.groupBy(fold).agg(
        F.map_from_entries(F.collect_list(F.struct("label", F.struct(*sums)))).alias("own"), F.sum("n").alias("test_rows")
    )
    total = own.groupBy("label").agg(*[F.sum(s).alias(s) for s in sums])
    packed = total.agg(F.collect_list(F.struct("label", *sums)).alias("total"))  # one entry per class

    def trained(entry: Column) -> Column:
        mine = F.try_element_at(F.col("own"), entry["label"])
        left = lambda s: entry[s] - F.coalesce(mine[s], F.lit(0))
        n = left("n")
        mean = lambda c: F.try_divide(left(f"sum_{c}"), n).alias(c)
        return F.struct(entry["label"].alias("label"), n.alias("n"), *[mean(c) for c in FEATURE_COLUMNS])

    joined = per_fold.withColumn("total", packed.scalar())
    model = F.filter(F.transform("total", trained), lambda m: m["n"] > 0)
    return joined.select(
        fold,
        model.alias("model"),
        F.aggregate(model, F.lit(0).cast("bigint"), lambda acc, m: acc + m["n"]).alias("training_rows"),
        "test_rows",
    ).withColumn("status", F.when(F.size("model") < 2, "insufficient_training_classes").otherwise("assessed"))


def logo_folds(rows: DataFrame, fold: str = "fold") -> DataFrame:
    """Sizes and status of every leave-one-group-out fold."""
    return fold_statistics(rows, fold).select(
        fold, "training_rows", "test_rows", F.size("model").cast("bigint").alias("training_classes"), "status"
    )


def logo_predictions(rows: DataFrame, fold: str = "fold") -> DataFrame:
    """Each row predicted by the centroids of all other groups, all folds in one query.

    Folds that cannot be trained give no predictions.
    """
    models = fold_statistics(rows, fold).filter("status = 'assessed'").select(fold, "model")
    joined = rows.join(models, fold)
    return joined.withColumn("pred", _nearest(F.col("model"))).drop("model")


def fit_forest(rows: DataFrame, trees: int = 40, depth: int = 6, seed: int = 7) -> PipelineModel:
    """Random forest on mean colours. It stands in for a kernel machine and does not equal one."""
    labelled = rows.withColumn("label_text", F.col("label").cast("string"))
    indexer = StringIndexer(inputCol="label_text", outputCol="label_index", stringOrderType="alphabetAsc", handleInvalid="keep")
    fitted = indexer.fit(labelled)
    return Pipeline(
        stages=[
            fitted,
            VectorAssembler(inputCols=list(FEATURE_COLUMNS), outputCol="features", handleInvalid="error"),
            RandomForestClassifier(
                labelCol="label_index", featuresCol="features", numTrees=trees, maxDepth=depth, seed=seed, predictionCol="class_index"
            ),
            IndexToString(inputCol="class_index", outputCol="predicted_text", labels=fitted.labels + ["255"]),
        ]
    ).fit(labelled)


def classify_forest(rows: DataFrame, model: PipelineModel, out: str = "predicted") -> DataFrame:
    """Forest prediction per row, distributed."""
    scored = model.transform(rows.withColumn("label_text", F.lit("0")))
    return scored.select(*rows.columns, F.col("predicted_text").cast("smallint").alias(out))


def assess_forest(rows: DataFrame, held_out: list, fold: str = "fold", **options) -> DataFrame:
    """Forest predictions for the named folds, one distributed fit per fold.

    ``held_out`` is the caller's list of sites, a handful; ``logo_predictions`` covers
    any number of groups in one query.
    """
    parts = []
    for group in held_out:
        test, train = rows.filter(F.col(fold) == group), rows.filter(F.col(fold) != group)
        parts.append(classify_forest(test, fit_forest(train, **options), "pred"))
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged


def classify_cells(cells: DataFrame, predictions: DataFrame) -> DataFrame:
    """Predicted segment classes written back to cells with validity and exclusion applied."""
    painted = paint_segments(cells, predictions)
    code = final_class(F.col("predicted"), F.col("segment_id"), F.col("valid"), F.col("excluded"))
    return painted.withColumn("cls", code).drop("predicted")
