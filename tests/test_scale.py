"""Registered queries and their operators on tables larger than, or placed unlike, the smallest given ones."""

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from floe.functions import footprints
from floe.operators.focal import TASK_CELLS, _block_tasks
from floe.operators.masks import rasterize_mask
from floe.queries.fixtures import UNIT_AFFINE
from test_queries import SF, sorted_rows


def final_plan(df):
    """What ran, without the plan made beforehand."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_clipped_width_of_concave_outlines(spark, tmp_path):
    """Every outline of a full period of positions and sizes: where only one prong of an outline is in the box, it alone counts."""
    con = duckdb.connect()
    con.execute(f"COPY (SELECT range AS s_suppkey FROM range(21150)) TO '{tmp_path}/supplier.parquet'")
    con.execute(f"CREATE VIEW supplier AS SELECT * FROM '{tmp_path}/supplier.parquet'")
    clipped = entry.queries()["j23_clip_polygons"](spark, str(tmp_path))
    cursor = con.execute(entry.oracle_sql()["j23_clip_polygons"])
    got, want = sorted_rows(clipped.columns, clipped.collect()), sorted_rows([d[0] for d in cursor.description], cursor.fetchall())
    assert got == want
    # 636: corner (2, 32), size 10; above y = 49.8 its right prong reaches from 10.9 to 12
    assert (636.0, "land", 1.1) in got


def test_ordered_pairs_are_made_once(spark):
    """Scenes are judged once for both sides of a pair, and pairs are made once for their places and for the hours' sizes."""
    assert final_plan(entry.queries()["o1_pair_order"](spark, SF)).count("ArrowEvalPython") == 2


def test_packed_rings():
    points = np.array([[[0, 0], [4, 0], [4, 3], [4, 3]], [[1, 1], [1, 1], [1, 1], [1, 1]], [[0, 0], [2, 0], [2, 2], [0, 2]]], dtype=float)
    packed, kept, counts = footprints.pack(points)
    assert counts.tolist() == [3, 1, 4]
    for back in (footprints.unpack(packed), footprints.unpack(packed.cast(pa.large_binary())), kept):
        assert (back == points).all()
    assert (footprints.unpack(packed.slice(2)) == points[2:]).all() and len(footprints.unpack(packed.slice(3))) == 0


def test_concave_pairs_judge_scenes_and_measure_pairs_once(spark):
    assert final_plan(entry.queries()["j2_concave_overlap"](spark, SF)).count("ArrowEvalPython") == 2


def test_convex_ring_clips_the_concave_one(monkeypatch):
    """One clip of four half planes in place of a clip for each of the concave ring's triangles."""
    ell = np.array([[[0, 0], [4, 0], [4, 2], [2, 2], [2, 4], [0, 4]]], dtype=float)
    box = np.array([[[1, 1], [5, 1], [5, 5], [1, 5]]], dtype=float)
    clips, clip = [], footprints.clip
    monkeypatch.setattr(footprints, "clip", lambda s, c: clips.append(len(s)) or clip(s, c))
    packed = [footprints.pack(v)[0] for v in (box, ell)]
    yes, no = pa.array([True]), pa.array([False])
    area = footprints.common_area().func
    assert area(packed[0], yes, packed[1], no).to_pylist() == pytest.approx([5.0]) and clips == [1]
    assert area(packed[1], no, packed[0], yes).to_pylist() == pytest.approx([5.0]) and clips == [1, 1]
    assert area(packed[1], no, packed[1], no).to_pylist() == pytest.approx([12.0])


def test_two_concave_rings_are_measured_without_clips(monkeypatch):
    """Edge by edge, not a clip of three half planes for each of a ring's triangles."""
    ell = np.array([[[0, 0], [4, 0], [4, 2], [2, 2], [2, 4], [0, 4]]], dtype=float)
    notch = np.array([[[1, 1], [5, 1], [5, 5], [3, 1.5], [1, 5], [1, 1]]], dtype=float)
    clips, clip = [], footprints.clip
    monkeypatch.setattr(footprints, "clip", lambda s, c: clips.append(len(s)) or clip(s, c))
    first, second = (footprints.pack(np.concatenate(v))[0] for v in ((np.pad(ell, ((0, 0), (0, 2), (0, 0)), "edge"),) * 2, [np.pad(v, ((0, 0), (0, 8 - v.shape[1]), (0, 0)), "edge") for v in (notch, ell + 4)]))
    no = pa.array([False, False])
    # the notch's left prong: x from 1 to 2 below 4 and below its slope from (1, 5) to (3, 1.5), then a strip up to y = 2 or the slopes
    slope = lambda x: 5 - 1.75 * (x - 1) if x < 3 else 1.5 + 1.75 * (x - 3)
    xs = 1 + (np.arange(300_000) + 0.5) / 100_000
    strip = sum(min(4 if x < 2 else 2, slope(x)) - 1 for x in xs) / 100_000
    assert footprints.common_area().func(first, no, second, no).to_pylist() == pytest.approx([strip, 0.0], abs=1e-8)
    assert clips == []


def test_edgewise_area_equals_clips_of_convex_rings():
    """Also where edges lie on each other, end on each other or stand upright."""
    quads = np.array([[[x, y], [x + w, y], [x + w + t, y + 2], [x + t, y + 2]] for x in (0, 1, 2) for y in (0, 1, 2) for w in (1, 2) for t in (-1, 0, 1)], dtype=float)
    first, second = (quads[k.ravel()] for k in np.indices((len(quads),) * 2))
    assert footprints._edgewise_area(first, second) == pytest.approx(np.maximum(footprints.signed_area(footprints.clip(first, second)), 0), abs=1e-12)


def test_half_plane_works_on_the_rings_it_cuts(monkeypatch):
    """Of 40 scenes of which 3 reach beyond one side of the frame, 3 are cut and the others stay."""
    inner = np.array([[1, 1], [2, 1], [2, 2], [1, 2]], dtype=float)
    rings, frame = np.repeat(inner[None], 40, axis=0), np.repeat(np.array([[[0, 0], [9, 0], [9, 9], [0, 9]]], dtype=float), 40, axis=0)
    rings[[3, 8, 30], 1:3, 0] = 12
    before, rows, cut = rings.copy(), [], footprints._cut
    monkeypatch.setattr(footprints, "_cut", lambda p, s: rows.append(len(p)) or cut(p, s))
    left = footprints.signed_area(footprints.clip(rings, frame))
    assert rows == [3] and left.tolist() == [8.0 if k in (3, 8, 30) else 1.0 for k in range(40)] and (rings == before).all()


def test_closing_corners_are_dropped_in_the_batch():
    rings = [[(0, 0), (4, 0), (4, 4), (0, 0)], [(0, 0), (4, 0), (4, 4)], [(0, 0), (4, 0), (0, 0)], [(1, 1), (1, 1)], [], [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]]
    kind = pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))
    points, counts = footprints.opened(*footprints.corners(pa.array([[{"x": x, "y": y} for x, y in r] for r in rings], kind)))
    assert counts.tolist() == [3, 3, 2, 1, 0, 4] and (points[0] == points[1]).all()
    judged = footprints.judge(((0, 0), (8, 0), (8, 8), (0, 8))).func(pa.array([[{"x": x, "y": y} for x, y in r] for r in rings], kind)).to_pylist()
    assert [(j["simple"], j["share"]) for j in judged] == [(True, 0.125), (True, 0.125), (False, 0), (False, 0), (False, 0), (True, 0.25)]


def test_pairs_leave_boxes_behind(spark):
    """Boxes end at the join, what is measured are the rings alone, and the scenes of one exchange serve both sides."""
    plan = final_plan(entry.queries()["j2_concave_overlap"](spark, SF)).splitlines()
    made = [k for k, line in enumerate(plan) if "ArrowEvalPython" in line]
    assert len(made) == 2 and "inside_1#" in plan[made[0] + 1] and "x0_1#" not in plan[made[0] + 1]


def test_texture_tasks_follow_the_raster(spark):
    """A raster of twice the cells is windowed by twice the tasks, not by larger ones."""
    cells = lambda height: spark.range(2).selectExpr("0L scene_id", "id row", "id col", f"{height}L height", "1000L width")
    tasks = [_block_tasks(cells(height), 8, 256, None) for height in (10_000, 20_000)]
    assert tasks[0] > 10_000 * 1000 / TASK_CELLS and tasks[1] == pytest.approx(2 * tasks[0], rel=0.05)
    assert _block_tasks(cells(10_000), 8, 256, cells(20_000)) == tasks[1]


def test_crossings_of_one_grid_are_spread(spark):
    """Edges that a join left in one partition by grid still give spans in several, by row."""
    sides = spark.range(60).selectExpr("id * 0 scene_id", "id poly_id", "id * 3D x", "id * 4D y", "explode(array(0D, 5D)) d")
    edges = sides.selectExpr("scene_id", "poly_id", "300L height", "300L width", "x + d x1", "y y1", "x + d x2", "y + 5D y2")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spans = rasterize_mask(edges.repartition("scene_id"), UNIT_AFFINE, ["scene_id"])
        assert spans.select(F.spark_partition_id()).distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
