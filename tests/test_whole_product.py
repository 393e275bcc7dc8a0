"""Sampled texture, the growing store and polygon identity."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from floe.operators import products as P
from floe.operators.cells import cells_to_tiles
from floe.operators.focal import sampled_texture, texture_tiles
from floe.operators.masks import mark_cells, polygon_edges, rasterize_mask, surface_counts
from floe.operators.tile_texture import sample_positions, textures
from floe.plans.pair_product import UNIT, with_spans
from floe.sources.polygons import on_map, parse_polygons, read_polygons
from floe.sources.products import committed, decide, publish, read_published
from floe.streaming.incremental import plan_work


@pytest.mark.parametrize("extent, factor, tile", [(7, 2, 4), (64, 10, 16), (65, 3, 16), (5, 8, 2), (1, 1, 4)])
def test_sampled_positions_cover_the_coarse_axis_once(extent, factor, tile):
    many = -(-extent // factor)
    found = [np.stack(sample_positions(lo, min(lo + tile, extent), extent, factor), 1) for lo in range(0, extent, tile)]
    found = np.concatenate(found)
    assert found[:, 0].tolist() == list(range(many))
    assert found[:, 1].tolist() == [int((o + 0.5) * extent / many) for o in range(many)]


def test_sampled_means_equal_the_whole(rng=np.random.default_rng(4)):
    a, b = rng.normal(size=(2, 40, 30))
    a[3:9, 5:12] = np.nan
    where = np.array([0, 4, 17, 39]), np.array([2, 11, 29])
    for whole, few in zip(textures(a, b, (5, 9), 0.8), textures(a, b, (5, 9), 0.8, where)):
        assert np.array_equal(whole[np.ix_(*where)], few, equal_nan=True)


def test_tile_kernel_masks_and_samples(spark, raster):
    rng = np.random.default_rng(5)
    a, b = rng.uniform(0.1, 4, size=(2, 37, 29))
    a[0, 0] = -1.0  # no decibels
    spans = [(0, 10, 3, 20), (0, 11, 0, 28), (0, 36, 28, 28)]
    masked = [np.where(v > 0, 10 * np.log10(np.abs(v)), np.nan) for v in (a, b)]
    for image in masked:
        for _, r, lo, hi in spans:
            image[r, lo : hi + 1] = np.nan
    raw = raster(a=a, b=b).withColumn("grid_id", F.lit(0))
    tiles = cells_to_tiles(raw, 16, ["a", "b"]).withColumn("grid_id", F.lit(0))
    tiles = with_spans(tiles, spark.createDataFrame(spans, "grid_id int, row bigint, lo bigint, hi bigint"), 16)
    got = {(r.row, r.col): (r.t1, r.t2) for r in sampled_texture(tiles, (5, 9), 3, tile=16, units="linear_power").collect()}
    whole = {}
    for t in texture_tiles(cells_to_tiles(raster(a=masked[0], b=masked[1]), 16, ["a", "b"]), (5, 9), tile=16, precision="double").collect():
        for k, pair in enumerate(zip(t.t1, t.t2)):
            whole[t.row0 + k // t.w, t.col0 + k % t.w] = pair
    assert sorted(got) == [(r, c) for r in range(13) for c in range(10)]
    for (r, c), pair in got.items():
        expected = whole[int((r + 0.5) * 37 / 13), int((c + 0.5) * 29 / 10)]
        assert [v is None for v in pair] == [v is None for v in expected]
        assert np.allclose([v or 0 for v in pair], [v or 0 for v in expected], atol=1e-9)


PRODUCT = "pair_id string, fingerprint string, ice double"


def test_store_grows_reuses_and_refuses(spark, tmp_path):
    root = str(tmp_path / "store")
    batch = lambda rows: spark.createDataFrame(rows, PRODUCT)
    outcome = lambda rows: {(r.pair_id, r.fingerprint): r.action for r in publish(batch(rows), root).collect()}
    assert outcome([("a", "1", 1.0), ("a", "1", 2.0), ("b", None, 3.0), ("c", "1", 4.0), ("c", "2", 5.0)]) == {
        ("a", "1"): "process", ("b", None): "process", ("c", "1"): "conflict", ("c", "2"): "conflict",
    }
    assert outcome([("a", "1", 9.0), ("b", None, 9.0), ("b", "7", 9.0), ("d", "1", 6.0)]) == {
        ("a", "1"): "reuse", ("b", None): "conflict", ("b", "7"): "conflict", ("d", "1"): "process",
    }
    assert outcome([("a", "2", 9.0)]) == {("a", "2"): "conflict"}
    assert outcome([]) == {}
    assert sorted((r.pair_id, r.ice) for r in read_published(spark, root).select("pair_id", "ice").collect()) == [("a", 1.0), ("a", 2.0), ("b", 3.0), ("d", 6.0)]


def test_unlogged_rows_and_late_rivals_stay_unseen(spark, tmp_path):
    root = str(tmp_path / "store")
    rows = spark.createDataFrame([("a", "1", 1.0)], PRODUCT)
    publish(rows, root)
    rows.withColumn("ice", F.lit(7.0)).write.parquet(f"{root}/data/commit=lost")  # a job that ended before its log entry
    rows.withColumn("ice", F.lit(8.0)).write.parquet(f"{root}/data/commit=9")
    spark.createDataFrame([("a", "2", "9")], "pair_id string, fingerprint string, commit string").write.mode("append").parquet(f"{root}/log")
    assert [r.ice for r in read_published(spark, root).collect()] == [1.0]
    assert [r.fingerprint for r in committed(spark, root).collect()] == ["1"]


def test_one_reuse_rule(spark):
    wanted = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", None), ("d", "1"), ("e", "1")], "pair_id string, fingerprint string")
    stored = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "2"), ("b", "3"), ("c", None), ("d", None)], "pair_id string, fingerprint string")
    plan = {r.pair_id: r.action for r in plan_work(wanted, stored).collect()}
    names = lambda df: {r.pair_id for r in df.collect()}
    assert plan == {"a": "reuse", "b": "conflict", "c": "conflict", "d": "conflict", "e": "process"}
    assert names(P.reused_pairs(wanted, stored)) == {"a"}
    assert names(P.conflicting_pairs(wanted, stored)) == {"b", "c", "d"}
    assert names(P.new_pairs(wanted, stored)) == {"e"}
    assert {r.pair_id: r.action for r in decide(wanted, stored).collect()} == plan


def square(x, y, size, hole=False):
    ring = [[x, y], [x + size, y], [x + size, y + size], [x, y + size], [x, y]]
    return [ring, square(x + 1, y + 1, size - 2)[0]] if hole else [ring]


def feature(kind, coordinates, surface="land", **more):
    return {"properties": {"surface": surface, **more}, "geometry": {"type": kind, "coordinates": coordinates}}


def covered(spark, polygons):
    edges = polygon_edges(polygons, ["poly_id"]).withColumns({"g": F.lit(0), "height": F.lit(20).cast("bigint"), "width": F.lit(20).cast("bigint")})
    cells = spark.range(400).select(F.lit(0).alias("g"), F.expr("id div 20").alias("row"), F.expr("id % 20").alias("col"))
    return mark_cells(cells, rasterize_mask(edges, UNIT, ["g"]), ["g"]).filter("excluded").count()


def test_repeated_overlapping_holed_and_split_features(spark, tmp_path):
    same = feature("Polygon", square(2, 2, 4))
    cases = {
        "twice": ([same, same], 16, 2), "numbered alike": ([feature("Polygon", square(2, 2, 4), poly_id=5), feature("Polygon", square(4, 4, 4), poly_id=5)], 28, 2),
        "hole": ([feature("Polygon", square(2, 2, 6, hole=True))], 20, 1), "parts": ([feature("MultiPolygon", [square(0, 0, 2), square(10, 10, 3)]), same], 29, 2),
    }
    for name, (features, cells, count) in cases.items():
        path = tmp_path / f"{name}.json"
        path.write_text(json.dumps({"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "urn:ogc:def:crs:EPSG::3031"}}, "features": features}))
        polygons = read_polygons(spark, str(path))
        assert covered(spark, polygons) == cells, name
        assert [r.polygons for r in surface_counts(polygons).collect()] == [count]
        assert {r.crs for r in polygons.collect()} == {"EPSG:3031"}
    lines = spark.createDataFrame([(json.dumps(same),), (json.dumps(same),), (json.dumps(feature("Polygon", square(4, 4, 4))),)], "json string")
    assert covered(spark, parse_polygons(lines)) == 28


def test_reference_systems_of_files(spark, tmp_path):
    plain = {"type": "FeatureCollection", "features": [feature("Polygon", square(76, -69, 1))]}
    (tmp_path / "plain.json").write_text(json.dumps(plain))
    found = on_map(read_polygons(spark, str(tmp_path / "plain.json"))).collect()[0]
    assert found.crs == "EPSG:3031" and all(abs(p.x) > 1e6 or abs(p.y) > 1e5 for p in found.ring)
    (tmp_path / "odd.json").write_text(json.dumps(plain | {"crs": {"properties": {"name": "EPSG:32733"}}}))
    with pytest.raises(Exception, match="unknown reference system"):
        read_polygons(spark, str(tmp_path / "odd.json")).collect()
