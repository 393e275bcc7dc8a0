import pytest
from pyspark.sql import functions as F

from floe.functions import encode
from floe.operators import metrics, zonal


def test_unknown_is_never_retreat(spark):
    prev, curr = [[0, 2, 2, 3], [1, 255, 2, 0]], [[2, 0, 3, 2], [1, 2, 255, 0]]
    rows = [(r, c, prev[r][c], curr[r][c], 1.0) for r in range(2) for c in range(4)]
    cells = metrics.change_cells(spark.createDataFrame(rows, "row int, col int, prev int, curr int, area_km2 double"))
    total = metrics.change_metrics(cells, []).first()
    assert (total.gain_km2, total.loss_km2, total.persistent_km2, total.common_km2, total.net_km2) == (1, 1, 2, 5, 0)
    assert cells.filter("change = 255").count() == 3


def test_confusion_has_all_nine_cells(spark):
    rows = spark.createDataFrame([("a", 0, 0), ("a", 2, 3), ("b", 2, 2)], "fold string, label int, pred int")
    matrix = {(r.fold, r.label, r.pred): r.segments for r in metrics.confusion(rows).collect()}
    assert len(matrix) == 18 and sum(matrix.values()) == 3 and matrix["a", 2, 3] == 1 and matrix["b", 3, 3] == 0
    accuracy = {r.fold: r.balanced_accuracy for r in metrics.balanced_accuracy(rows).collect()}
    assert accuracy == {"a": 0.5, "b": 1.0}


def test_ratios_are_null_without_denominator(spark):
    cells = spark.createDataFrame([("s", 0, 1, True, False, 2.0), ("s", 255, 0, True, True, 3.0), ("t", 1, 2, False, False, 1.0)], "scene_id string, cls int, validity int, in_domain boolean, in_reference boolean, area_km2 double")
    rows = {r.scene_id: r for r in metrics.outline_assessment(metrics.overlay(cells), ["scene_id"]).collect()}
    s = rows["s"]
    assert (s.tn_km2, s.ocean_km2, s.unassessed_km2, s.precision, s.recall, s.iou, s.problem) == (2, 5, 3, None, None, None, None)
    assert rows["t"].problem == "domain outside grid"


def test_zonal_means_on_sparse_ids(spark):
    cells = spark.createDataFrame([("s", 0, 9, 9, 9), ("s", 2, 10, 0, 255), ("s", 2, 20, 1, 255), ("s", 99, 1, 2, 3)], "scene_id string, segment_id bigint, r int, g int, b int")
    got = [tuple(r) for r in zonal.segment_features(cells).orderBy("segment_id").collect()]
    assert got == [("s", 2, 15.0, 0.5, 255.0, 2), ("s", 99, 1.0, 2.0, 3.0, 1)]


def test_majority_needs_purity(spark):
    rows = [("s", 1, 2)] * 9 + [("s", 1, 0)] + [("s", 2, 2)] * 8 + [("s", 2, 0)] * 2 + [("s", 3, 3), ("s", 3, 255), ("s", 3, 1), ("s", 4, 255), ("s", 0, 2)]
    got = zonal.majority_labels(spark.createDataFrame(rows, "scene_id string, segment_id bigint, label int"))
    assert {(r.segment_id, r.label) for r in got.collect()} == {(1, 2), (3, 3)}


def test_smaller_mask_wins_then_later(spark):
    masks = spark.createDataFrame([(1, 0, 9), (2, 0, 4), (3, 0, 4), (1, 1, 9)], "mask_id int, cell int, area int")
    assert {(r.cell, r.mask_id) for r in zonal.paint_masks(masks, ["cell"]).collect()} == {(0, 3), (1, 1)}


def test_write_back_precedence(spark):
    rows = [(1, 2, 5, True, False), (2, 2, 0, True, False), (3, 2, 5, False, False), (4, 2, 0, False, True), (5, None, 7, True, False)]
    df = spark.createDataFrame(rows, "k int, p int, segment_id bigint, valid boolean, excluded boolean")
    code = encode.final_class(F.col("p"), F.col("segment_id"), F.col("valid"), F.col("excluded"))
    assert [r.c for r in df.orderBy("k").select(code.alias("c")).collect()] == [2, 255, 255, 1, 255]


def test_codes_are_closed(spark):
    df = spark.createDataFrame([(0,), (3,), (255,), (7,)], "cls int")
    assert [tuple(r) for r in encode.unknown_codes(df).collect()] == [(7, 1)]
    with pytest.raises(Exception, match="unknown class code: 7"):
        encode.assert_codes(df).collect()
    with pytest.raises(Exception, match="illegal label: 1"):
        spark.range(1).select(encode.usable_label(F.lit(1), F.lit(1), F.lit(1)).alias("x")).collect()


def test_display_codes(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (3,), (255,)], "cls int")
    got = {r.cls: (r.r, r.g, r.b, r.alpha) for r in encode.class_rgba(df).collect()}
    assert got == {0: (15, 35, 48, 255), 1: (88, 94, 99, 255), 2: (68, 218, 100, 255), 3: (240, 170, 40, 255), 255: (235, 235, 235, 0)}
