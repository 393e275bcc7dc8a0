"""Whole pair products on many grids: reuse check, both regrids, tile texture, segments, classes, pictures, publication.

Tables: ``pairs`` (``pair_id, fingerprint, grid_id``), ``grids`` (``grid_id, a, c, e, f, height, width``: north-up
transform in map metres and shape), ``sources`` (``pair_id, side`` 1 or 2, ``a, c, e, f, height, width``) and ``cells``
(``pair_id, side, row, col, value``: raw cells of both scenes). What has a row a pair or grid is broadcast to cells,
tiles and edges: a shuffle by pair would put all cells of a pair into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floe.functions.encode import class_rgba, composite_rgba, encode_rgb, validity_code
from floe.functions.geo import areal_scale
from floe.operators.cells import cells_to_tiles, regrid_bilinear
from floe.operators.classify import classify_cells, classify_nearest
from floe.operators.focal import sampled_texture
from floe.operators.masks import mark_cells, rasterize_mask
from floe.operators.superpixels import superpixels
from floe.operators.zonal import segment_features
from floe.plans.product import Settings
from floe.schema import Affine
from floe.session import durable
from floe.sources.products import committed, decide, publish

UNIT = Affine(1.0, 0.0, 0.0, 0.0, 1.0, 0.0)


def target_points(pairs: DataFrame, grids: DataFrame, sources: DataFrame, side: int) -> DataFrame:
    """Every cell of every pair's grid with its place in one of the pair's scenes."""
    scene = sources.filter(F.col("side") == side).select("pair_id", *[F.col(c).alias(f"s_{c}") for c in ("a", "c", "e", "f", "height", "width")])
    placed = pairs.join(grids, "grid_id").join(scene, "pair_id")
    rows = placed.withColumn("row", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("height") - 1)))
    rows = rows.repartition("pair_id", "row")  # a grid's rows are spread before they unfold
    every = rows.withColumn("col", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("width") - 1)))
    x, y = F.col("c") + (F.col("col") + 0.5) * F.col("a"), F.col("f") + (F.col("row") + 0.5) * F.col("e")
    return every.select(
        F.col("pair_id").alias("scene_id"), "row", "col", ((y - F.col("s_f")) / F.col("s_e")).alias("src_row"), ((x - F.col("s_c")) / F.col("s_a")).alias("src_col"),
        F.col("s_height").alias("src_height"), F.col("s_width").alias("src_width"),
    )


def aligned_tiles(pairs: DataFrame, grids: DataFrame, sources: DataFrame, cells: DataFrame, tile: int) -> DataFrame:
    """Both scenes of every pair on the pair's grid, as array tiles that meet tile by tile."""
    shapes = pairs.join(grids, "grid_id").select(F.col("pair_id").alias("scene_id"), "grid_id", "height", "width")

    def one(side: int, name: str) -> DataFrame:
        scene = sources.filter(F.col("side") == side).select("pair_id", "height", "width")
        raw = cells.filter(F.col("side") == side).join(F.broadcast(scene), "pair_id").select(F.col("pair_id").alias("scene_id"), "row", "col", "height", "width", F.col("value").alias(name))
        made = regrid_bilinear(target_points(pairs, grids, sources, side), raw, [name], grids=scene.withColumnRenamed("pair_id", "scene_id"))
        return cells_to_tiles(made.join(F.broadcast(shapes), "scene_id"), tile, [name])

    keys = ["scene_id", "ty", "tx", "row0", "col0", "h", "w", "height", "width"]
    return one(1, "a").join(one(2, "b"), keys).join(F.broadcast(shapes.select("scene_id", "grid_id")), "scene_id")


def grid_spans(edges: DataFrame, grids: DataFrame, factor: int = 1) -> DataFrame:
    """Excluded row spans of every grid, or of the same grid decimated; built once a grid, whatever its pairs.

    ``edges``: ``grid_id, poly_id, x1, y1, x2, y2`` in map metres.
    """
    many = lambda n: F.ceil(F.col(n) / factor).cast("bigint")
    u = lambda x: (F.col(x) - F.col("c")) / F.col("a") * many("width") / F.col("width")
    v = lambda y: (F.col(y) - F.col("f")) / F.col("e") * many("height") / F.col("height")
    placed = edges.join(F.broadcast(grids), "grid_id").select(
        "grid_id", "poly_id", u("x1").alias("x1"), v("y1").alias("y1"), u("x2").alias("x2"), v("y2").alias("y2"), many("height").alias("height"), many("width").alias("width")
    )
    return rasterize_mask(placed, UNIT, ["grid_id"])


def with_spans(tiles: DataFrame, spans: DataFrame, tile: int) -> DataFrame:
    """Tiles with the spans that touch them (at most a tile's rows times the gaps in a row)."""
    listed = spans.withColumn("tx", F.explode(F.sequence(F.floor(F.col("lo") / tile), F.floor(F.col("hi") / tile))))
    each = listed.groupBy("grid_id", F.floor(F.col("row") / tile).alias("ty"), "tx").agg(F.collect_list(F.struct("row", "lo", "hi")).alias("spans"))
    return tiles.join(each, ["grid_id", "ty", "tx"], "left")


def segmented_cells(tiles: DataFrame, pairs: DataFrame, grids: DataFrame, edges: DataFrame, settings: Settings) -> DataFrame:
    """Colour-encoded, segmented cells of the decimated grids with validity, transform and true area."""
    f = settings.downsample
    texture = sampled_texture(with_spans(tiles, grid_spans(edges, grids), settings.tile), settings.widths, f, settings.min_fraction, settings.tile, settings.units)
    coarse = lambda n: F.ceil(F.col(n) / f).cast("bigint")
    shapes = pairs.join(grids, "grid_id").select(
        F.col("pair_id").alias("scene_id"), "grid_id", "c", "f", (F.col("a") * F.col("width") / coarse("width")).alias("a"), (F.col("e") * F.col("height") / coarse("height")).alias("e"),
        coarse("height").alias("height"), coarse("width").alias("width"),
    )
    cells = durable(encode_rgb(texture).drop("t1", "t2", "t3").join(F.broadcast(shapes), "scene_id"))
    found = superpixels(cells, settings.n_segments, settings.compactness, settings.rounds, settings.max_pixels)
    marked = mark_cells(found, grid_spans(edges, grids, f), ["grid_id"])
    x, y = F.col("c") + (F.col("col") + 0.5) * F.col("a"), F.col("f") + (F.col("row") + 0.5) * F.col("e")
    area = F.abs(F.col("a") * F.col("e")) / 1e6 / areal_scale(x, y)
    return marked.withColumns({"validity": validity_code(F.col("valid"), F.col("excluded")), "area_km2": area})


def _picture(rgba: DataFrame, name: str) -> DataFrame:
    return rgba.withColumn(name, F.struct("r", "g", "b", "alpha")).drop("alpha")


def classified_cells(cells: DataFrame, centres: DataFrame) -> DataFrame:
    """Classes by segment, with the composite and the class picture beside each cell."""
    features = segment_features(cells).withColumnsRenamed({f"mean_{c}": c for c in "rgb"})
    done = classify_cells(cells, classify_nearest(features, centres))
    kept: list[Column] = [F.col(c) for c in done.columns if c not in "rgb"]
    shown = _picture(class_rgba(_picture(composite_rgba(done), "composite")), "colour")
    return shown.select(*kept, "composite", "colour")


def make_products(pairs: DataFrame, grids: DataFrame, sources: DataFrame, cells: DataFrame, edges: DataFrame, centres: DataFrame, settings: Settings, root: str) -> DataFrame:
    """Process what the store lacks, publish it, and return ``pair_id, fingerprint, existing, action`` of every candidate."""
    outcome = durable(decide(pairs, committed(pairs.sparkSession, root)))  # decided before the store grows
    # reused and conflicting pairs cost no processing
    todo = durable(pairs.join(outcome.filter("action = 'process'").select("pair_id"), "pair_id", "left_semi"))
    tiles = aligned_tiles(todo, grids, sources, cells.join(F.broadcast(todo.select("pair_id")), "pair_id", "left_semi"), settings.tile)
    made = classified_cells(segmented_cells(tiles, todo, grids, edges, settings), centres)
    named = made.withColumnRenamed("scene_id", "pair_id").join(F.broadcast(todo.select("pair_id", "fingerprint")), "pair_id")
    publish(named, root)
    return outcome
