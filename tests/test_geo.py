import math

import pytest
from pyspark.sql import functions as F

from floe.functions import geo
from floe.schema import Affine


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_known_point(spark):
    x, y = geo.polar_xy(77.9689, -68.5762)
    row = one(spark, x.alias("x"), y.alias("y"))
    assert row.x == pytest.approx(2302447.5913688634, abs=1e-6)
    assert row.y == pytest.approx(490706.7214961117, abs=1e-6)


def test_inverse_returns_the_point(spark):
    points = spark.createDataFrame([(-170.0, -62.5), (0.0, -89.0), (77.97, -68.58), (141.0, -71.0)], "lon double, lat double")
    x, y = geo.polar_xy("lon", "lat")
    back = points.withColumns({"x": x, "y": y})
    lon, lat = geo.lonlat("x", "y")
    for r in back.withColumns({"lon2": lon, "lat2": lat}).collect():
        assert r.lon2 == pytest.approx(r.lon, abs=1e-9)
        assert r.lat2 == pytest.approx(r.lat, abs=1e-9)


def test_area_is_nominal_at_true_scale(spark):
    x, y = geo.polar_xy(30.0, -71.0)
    k2 = one(spark, x.alias("x"), y.alias("y"))
    scale = spark.createDataFrame([(k2.x, k2.y)], "x double, y double").select(geo.areal_scale("x", "y").alias("k")).first().k
    assert scale == pytest.approx(1.0, abs=1e-12)
    rotated = geo.cell_area_km2(F.lit(0), F.lit(0), Affine(30, 40, 2.3e6, 40, -30, 5e5))
    assert one(spark, rotated.alias("a")).a == pytest.approx(2500 / 1e6, rel=0.05)
    with pytest.raises(ValueError):
        geo.cell_area_km2("row", "col", Affine(1, 0, 0, 0, -1, 0), crs="EPSG:4326")


def test_station_grids(spark):
    boxes = spark.createDataFrame([("davis", 75.5, -69.2, 80.5, -67.3)], "name string, west double, south double, east double, north double")
    grid = geo.grid_for_bbox(boxes, ["name"], 40).first()
    assert (grid.width, grid.height) == (6307, 6212)
    assert grid.left % 40 == 0 and grid.top % 40 == 0


def test_angular_grid_shrinks_spacing(spark):
    boxes = spark.createDataFrame(
        [(70.0, -68.0, 72.0, -67.0), (72.0, -68.0, 70.0, -67.0)], "west double, south double, east double, north double"
    )
    good, bad = geo.grid_for_lonlat(boxes, 0.3, 0.3).orderBy("west").collect()
    assert (good.width, good.height) == (7, 4)
    assert good.step_x * 7 == pytest.approx(2) and good.step_y * 4 == pytest.approx(1)
    assert not bad.usable and bad.width is None
    assert math.isclose(good.step_x, 2 / 7)
