import numpy as np
import pytest
from pyspark.sql import functions as F

from floe.functions.encode import encode_rgb, to_db
from floe.operators.cells import cells_to_tiles, densify, tiles_to_cells
from floe.operators.focal import masked_mean, normprod, texture_tiles


def window_mean(a, width, fraction, edge):
    """Plain loops, as an independent check."""
    h = width // 2
    out = np.full(a.shape, np.nan)
    n, m = a.shape
    for i in range(n):
        for j in range(m):
            values = []
            for r in range(i - h, i + h + 1):
                for c in range(j - h, j + h + 1):
                    if edge:
                        values.append(a[min(max(r, 0), n - 1), min(max(c, 0), m - 1)])
                    elif 0 <= r < n and 0 <= c < m:
                        values.append(a[r, c])
            seen = [v for v in values if np.isfinite(v)]
            if seen and len(seen) >= fraction * width * width:
                out[i, j] = sum(seen) / len(seen)
    return out


def plain_texture(a, b, width, fraction=0.8):
    mean = lambda v, edge=True: window_mean(v, width, fraction, edge)
    ma, mb = mean(a), mean(b)
    sa = np.sqrt(np.maximum(mean(a * a) - ma**2, 0))
    sb = np.sqrt(np.maximum(mean(b * b) - mb**2, 0))
    num, den = mean((a - ma) * (b - mb), False), mean(((sa + sb) / 2) ** 2)
    out = np.where((den > 1e-12) & np.isfinite(a) & np.isfinite(b), num / den, np.nan)
    return out


def as_array(df, name, shape):
    out = np.full(shape, np.nan)
    for r in df.select("row", "col", name).collect():
        if r[name] is not None:
            out[r.row, r.col] = r[name]
    return out


def sample(shape, seed=3):
    rng = np.random.default_rng(seed)
    a, b = rng.normal(-15, 2, shape), rng.normal(-15, 2, shape)
    b[:, : shape[1] // 2] = a[:, : shape[1] // 2]
    a[5:9, 6:12] = np.nan
    return a, b


@pytest.mark.parametrize("mode", ["nearest", "constant"])
def test_masked_mean_equals_loops(raster, mode):
    a, _ = sample((21, 26))
    got = as_array(masked_mean(raster(a=a), "a", 5, mode, block=8), "mean", a.shape)
    np.testing.assert_allclose(got, window_mean(a, 5, 0.8, mode == "nearest"), atol=1e-9)


def test_cells_tiles_and_loops_agree(raster):
    a, b = sample((37, 41))
    cells = raster(a=a, b=b)
    tiles = texture_tiles(cells_to_tiles(cells, 16, ["a", "b"]), (3, 5, 9), tile=16, precision="double")
    by_tile = tiles_to_cells(tiles, ["t1", "t2", "t3"])
    for k, width in enumerate((3, 5, 9), 1):
        expected = plain_texture(a, b, width)
        np.testing.assert_allclose(as_array(by_tile, f"t{k}", a.shape), expected, atol=1e-8)
    by_cell = as_array(normprod(cells, 9, block=16), "texture", a.shape)
    np.testing.assert_allclose(by_cell, expected, atol=1e-8)


def test_constant_image_has_no_texture(raster):
    flat = np.full((30, 30), 4.0)
    assert np.isnan(as_array(normprod(raster(a=flat, b=flat), 5, block=16), "texture", flat.shape)).all()


def test_hole_stays_missing_and_neighbours_survive(raster):
    a, b = sample((30, 30), 8)
    a[...] = np.where(np.isnan(a), -15, a)
    a[10, 10] = np.nan
    got = as_array(normprod(raster(a=a, b=b), 5, block=16), "texture", a.shape)
    assert np.isnan(got[10, 10]) and np.isfinite(got[3, 3]) and np.isfinite(got[10, 11])


@pytest.mark.parametrize("width,rim", [(11, 3), (21, 6)])
def test_rim_is_missing(raster, width, rim):
    rng = np.random.default_rng(1)
    a = rng.normal(size=(48, 48))
    tiles = texture_tiles(cells_to_tiles(raster(a=a, b=a), 48, ["a", "b"]), (width,), tile=48)
    got = as_array(tiles_to_cells(tiles, ["t1"]), "t1", a.shape)
    middle = got[24]
    assert np.isnan(middle[:rim]).all() and np.isfinite(middle[rim:-rim]).all() and np.isnan(middle[-rim:]).all()


def test_window_and_tile_guards(raster):
    cells = raster(a=np.ones((4, 4)), b=np.ones((4, 4)))
    tiles = cells_to_tiles(cells, 4, ["a", "b"])
    with pytest.raises(ValueError):
        texture_tiles(tiles, (4,))
    with pytest.raises(ValueError):
        texture_tiles(tiles, (9,), tile=4)
    with pytest.raises(ValueError):
        masked_mean(cells, "a", 3, "wrap")


def test_sparse_cells_do_not_become_tiles(spark, raster):
    cells = raster(a=np.arange(12.0).reshape(3, 4))
    sparse = cells.filter("not (row = 1 and col = 2)")
    with pytest.raises(Exception, match="densify"):
        cells_to_tiles(sparse, 4, ["a"]).collect()
    grid = spark.createDataFrame([("s", 3, 4)], "scene_id string, height bigint, width bigint")
    whole = densify(sparse, grid)
    back = as_array(tiles_to_cells(cells_to_tiles(whole, 2, ["a"]), ["a"]), "a", (3, 4))
    assert np.isnan(back[1, 2]) and np.nansum(back) == 66 - 6


def test_rgb_clips_and_keeps_black_apart_from_missing(spark):
    df = spark.createDataFrame([(1, -1.0, -1.0, -1.0), (2, 2.0, 0.0, 0.25), (3, None, 0.5, 0.5)], "k int, t1 double, t2 double, t3 double")
    black, bright, missing = encode_rgb(df).orderBy("k").collect()
    assert (black.r, black.g, black.b, black.valid) == (0, 0, 0, True)
    assert (bright.r, bright.g, bright.valid) == (255, 85, True)
    assert (missing.r, missing.g, missing.b, missing.valid) == (0, 0, 0, False)


def test_power_to_db(spark):
    df = spark.createDataFrame([(0.01,), (0.0,), (-1.0,), (float("nan"),), (None,)], "p double")
    values = [r.v for r in df.select(to_db(F.col("p")).alias("v")).collect()]
    assert values[0] == pytest.approx(-20) and values[1:] == [None] * 4
