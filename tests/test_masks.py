import random

import pytest
from pyspark.sql import functions as F

from floe.operators import masks
from floe.schema import Affine

UNIT = Affine(1, 0, 0, 0, 1, 0)
RING = "poly_id bigint, surface string, ring array<struct<x:double,y:double>>"


def polygons(spark, *rows):
    return spark.createDataFrame([(k, s, [tuple(map(float, p)) for p in ring]) for k, s, ring in rows], RING)


def flagged(spark, polys, height, width, **options):
    shape = spark.createDataFrame([("g", height, width)], "scene_id string, height bigint, width bigint")
    edges = masks.polygon_edges(polys, ["poly_id"]).join(F.broadcast(shape))
    cells = shape.withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(height - 1)))).withColumn("col", F.explode(F.sequence(F.lit(0), F.lit(width - 1))))
    marked = masks.mark_cells(cells, masks.rasterize_mask(edges, UNIT, ["scene_id"], **options), ["scene_id"])
    assert marked.count() == height * width
    return {(r.row, r.col) for r in marked.filter("excluded").collect()}


def inside(x, y, ring):
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
            odd = not odd
    return odd


def test_centre_rule_equals_point_in_polygon(spark):
    rng = random.Random(4)
    star = [(10 + r * c, 9 + r * s) for r, c, s in [(9, 1, 0), (3, 0.7, 0.7), (8.3, 0, 1), (3, -0.7, 0.7), (9.5, -1, 0.1), (4, -0.7, -0.7), (8, 0, -1)]]
    blobs = [(k, "land", [(rng.uniform(-3, 24), rng.uniform(-3, 22)) for _ in range(3)]) for k in range(2, 6)]
    polys = [(1, "land", star), *blobs]
    expected = {(r, c) for r in range(20) for c in range(22) if any(inside(c + 0.5, r + 0.5, ring) for _, _, ring in polys)}
    assert flagged(spark, polygons(spark, *polys), 20, 22) == expected


def test_hole_by_parity(spark):
    outer, hole = [(1, 1), (9, 1), (9, 9), (1, 9)], [(3, 3), (6, 3), (6, 6), (3, 6)]
    got = flagged(spark, polygons(spark, (1, "land", outer), (1, "land", hole)), 10, 10)
    assert len(got) == 64 - 9 and (4, 4) not in got


def test_no_polygon_masks_nothing(spark):
    assert flagged(spark, polygons(spark).limit(0), 4, 4) == set()


def test_all_touched_is_conservative(spark):
    sliver = polygons(spark, (1, "land", [(0.2, 0.2), (5.8, 0.3), (5.8, 0.4)]))
    assert flagged(spark, sliver, 3, 8) == set()
    assert flagged(spark, sliver, 3, 8, all_touched=True) == {(0, c) for c in range(6)}


def test_clip_keeps_exact_area_of_concave_outline(spark):
    notch = [(0, 0), (4, 0), (4, 4), (2, 1), (0, 4)]
    far = [(50, 50), (51, 50), (51, 51)]
    got = masks.clip_polygons(polygons(spark, (1, "land", notch), (2, "ocean", notch), (3, "land", far)), -1, -1, 3, 3)
    from floe.functions.rings import area

    rows = got.select("poly_id", area(F.col("ring")).alias("a")).collect()
    # left of x = 3 and below y = 3: the box 9 minus the notch above it
    assert [(r.poly_id, pytest.approx(r.a, abs=1e-9)) for r in rows] == [(1, sum_area())]


def sum_area():
    height = lambda x: min(3.0, 4 - 1.5 * x if x < 2 else 1 + 1.5 * (x - 2))
    # the clipped outline's upper border is piecewise linear: integrate between its corners
    corners = sorted({0.0, 2 / 3, 2.0, 3.0})
    return sum((b - a) * (height(a) + height(b)) / 2 for a, b in zip(corners, corners[1:]))


def test_crossing_outline_is_refused(spark):
    good = [(0, 0), (4, 0), (4, 4), (0, 4)]
    bow = [(0, 0), (4, 4), (4, 0), (0, 4)]
    zigzag = [(x, (x * 7) % 5) for x in range(40)] + [(39, 30), (0, 30)]
    polys = polygons(spark, (1, "land", good), (2, "land", bow), (3, "land", zigzag))
    assert [r.poly_id for r in masks.crossing_polygons(polys).collect()] == [2]
    with pytest.raises(Exception, match="invalid polygon: 2"):
        masks.clip_polygons(polys, -1, -1, 50, 50).collect()


def test_spans_merge(spark):
    spans = spark.createDataFrame([("g", 0, 1, 3), ("g", 0, 2, 9), ("g", 0, 10, 12), ("g", 0, 20, 21), ("g", 1, 4, 4)], "scene_id string, row bigint, lo bigint, hi bigint")
    got = masks.merge_spans(spans, ["scene_id"]).select("row", "lo", "hi").orderBy("row", "lo").collect()
    assert [tuple(r) for r in got] == [(0, 1, 12), (0, 20, 21), (1, 4, 4)]
