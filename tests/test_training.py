import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from floe.operators import classify, training
from floe.operators.groups import acquisition_groups
from floe.operators.superpixels import superpixels
from floe.plans.training import fold_summary, train_from_annotations, train_from_labels


def test_vector_maps_by_segment_id(spark):
    scenes = spark.createDataFrame([("s", [0.0, 0.0, 2.0, float("nan"), 3.0, 1.0])], "scene_id string, annotations array<double>")
    cells = spark.createDataFrame([("s", k, 10 * k, 0, 0) for k in (0, 1, 2, 3, 5)], "scene_id string, segment_id bigint, r int, g int, b int")
    annotations = training.explode_annotations(scenes)
    labelled = training.label_segments(cells, annotations)
    assert {(r.segment_id, r.label) for r in labelled.collect()} == {(1, 0), (2, 2)}
    unused = training.unused_annotations(annotations, cells)
    assert [r.segment_id for r in unused.collect()] == [4]
    assert training.short_vectors(scenes, cells).isEmpty()
    longer = cells.union(spark.createDataFrame([("s", 6, 0, 0, 0)], cells.schema))
    assert training.short_vectors(scenes, longer).count() == 1
    assert training.bad_annotations(annotations).isEmpty()


def components(scenes):
    """Union by repeated relabelling, as an independent check."""
    label = {s: s for s, _, _ in scenes}
    changed = True
    while changed:
        changed = False
        low = {}
        for s, region, dates in scenes:
            for d in dates:
                low[region, d] = min(low.get((region, d), s), label[s])
        for s, region, dates in scenes:
            best = min(low[region, d] for d in dates)
            if best < label[s]:
                label[s], changed = best, True
    return label


def test_groups_are_transitive_and_regional(spark):
    rows = [(0, "a", ["d1", "d2"]), (1, "a", ["d2", "d3"]), (2, "a", ["d4", "d3"]), (3, "a", ["d4", "d5"]), (4, "b", ["d1", "d2"])]
    got = acquisition_groups(spark.createDataFrame(rows, "scene_id int, region string, dates array<string>"))
    assert {r.scene_id: r.group for r in got.collect()} == {0: 0, 1: 0, 2: 0, 3: 0, 4: 4}


def test_groups_on_long_chains_and_hot_dates(spark):
    rng = random.Random(2)
    chain = [(k, "c", [f"{k:04d}", f"{k + 1:04d}"]) for k in range(150)]
    hot = [(1000 + k, "h", ["same", f"own{k}"]) for k in range(80)]
    loose = [(2000 + k, "l", [f"{rng.randrange(60)}", f"{rng.randrange(60)}"]) for k in range(40)]
    rows = chain + hot + loose
    rng.shuffle(rows)
    got = acquisition_groups(spark.createDataFrame(rows, "scene_id int, region string, dates array<string>"))
    assert {r.scene_id: r.group for r in got.collect()} == components(rows)


def test_duplicates_name_both(spark):
    scenes = spark.createDataFrame(
        [("b", "r", ["1", "2"], "h1"), ("a", "r", ["3", "4"], "h1"), ("c", "r", ["5", "6"], "h2")], "scene_id string, region string, dates array<string>, rgb string"
    )
    pairs = training.duplicate_scenes(scenes, ["rgb"]).filter("scene_id <> first_scene").collect()
    assert [(r.first_scene, r.scene_id) for r in pairs] == [("a", "b")]
    cells = spark.createDataFrame([(s, 1, 1, 2, 3) for s in "abc"], "scene_id string, segment_id bigint, r int, g int, b int")
    annotations = spark.createDataFrame([(s, 1, 2) for s in "abc"], "scene_id string, segment_id bigint, label smallint")
    with pytest.raises(Exception, match="a and b"):
        train_from_annotations(scenes, cells, annotations, ["rgb"]).collect()


def test_preflight(spark):
    wanted = spark.createDataFrame([("a",), ("b",), ("a",)], "scene_id string")
    there = spark.createDataFrame([("a",)], "scene_id string")
    assert [r.scene_id for r in training.missing_scenes(wanted, there).collect()] == ["b"]
    assert [tuple(r) for r in training.repeated_requests(wanted).collect()] == [("a", 2)]


def blobs(spark, seed=1):
    rng = np.random.default_rng(seed)
    centre = {0: (40, 40, 40), 2: (120, 200, 60), 3: (220, 90, 180)}
    rows = []
    for k in range(240):
        label = (0, 2, 3)[k % 3]
        r, g, b = (float(v) for v in np.clip(rng.normal(centre[label], 12), 0, 255))
        rows.append((k, r, g, b, label, f"site{k % 4}"))
    return spark.createDataFrame(rows, "segment_id bigint, r double, g double, b double, label int, fold string")


def test_forest_separates_classes(spark):
    rows = blobs(spark)
    predicted = classify.classify_forest(blobs(spark, 9), classify.fit_forest(rows, trees=10))
    assert predicted.filter("predicted = label").count() > 230


def test_folds_equal_explicit_holdout(spark):
    rows = blobs(spark)
    data = rows.toPandas()
    got = {r.segment_id: r.pred for r in classify.logo_predictions(rows).collect()}
    for fold, test in data.groupby("fold"):
        train = data[data.fold != fold]
        centres = train.groupby("label")[["r", "g", "b"]].mean()
        for row in test.itertuples():
            distance = ((centres - [row.r, row.g, row.b]) ** 2).sum(axis=1)
            assert got[row.segment_id] == distance.idxmin()
    assert fold_summary(rows, "fold").filter("balanced_accuracy > 0.95").count() == 4


def test_fold_without_two_classes_is_reported(spark):
    rows = blobs(spark).withColumn("fold", F.when(F.col("label") == 0, "only").otherwise("rest")).filter("label <> 3")
    status = {r.fold: r.status for r in classify.logo_folds(rows).collect()}
    assert status == {"only": "insufficient_training_classes", "rest": "insufficient_training_classes"}
    assert classify.logo_predictions(rows).isEmpty()
    assert {(r.fold, r.label) for r in training.unseen_classes(rows).collect()} == {("only", 0), ("rest", 2)}


def test_feature_table_check(spark):
    good = training.validate_features(blobs(spark)).first()
    assert good.sound and good.classes == 3
    bad = training.validate_features(blobs(spark).withColumn("r", F.lit(256.0))).first()
    assert not bad.sound and bad.bad_features == 240


def test_manual_labels(spark):
    rows = [(r, c, "s", 1 if c < 5 else 2, 30 if c < 5 else 200, 0, 0, 0 if c < 5 else 2, 1) for r in range(6) for c in range(10)]
    rows.append((6, 0, "s", 1, 30, 0, 0, 2, 0))
    cells = spark.createDataFrame(rows, "row int, col int, scene_id string, segment_id bigint, r int, g int, b int, label int, validity int")
    got = {r.segment_id: (r.r, r.label) for r in train_from_labels(cells).collect()}
    assert got == {1: (30.0, 0), 2: (200.0, 2)}


def test_superpixels_follow_colour(spark):
    rows = [("s", r, c, 20, 20, not (r < 2 and c < 2), 0 if c < 11 else 255, 0, 0) for r in range(20) for c in range(20)]
    cells = spark.createDataFrame(rows, "scene_id string, row bigint, col bigint, height bigint, width bigint, valid boolean, r int, g int, b int")
    got = superpixels(cells, n_segments=16, rounds=3)
    assert got.count() == 400
    assert got.filter("not valid").filter("segment_id <> 0").isEmpty()
    assert got.filter("valid").agg(F.min("segment_id")).first()[0] >= 1
    mixed = got.filter("valid").groupBy("segment_id").agg(F.countDistinct("r").alias("colours")).filter("colours > 1")
    assert mixed.isEmpty()
    with pytest.raises(Exception, match="max_pixels"):
        superpixels(cells, n_segments=16, rounds=1, max_pixels=399).collect()
