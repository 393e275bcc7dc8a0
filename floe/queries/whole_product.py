"""Whole pair products on grids of different shape, held against brute force in SQL."""

import uuid

from pyspark.sql import functions as F

from floe.functions.identity import fingerprint
from floe.operators import classify
from floe.operators.masks import polygon_edges
from floe.operators.metrics import extent_metrics
from floe.plans.pair_product import make_products
from floe.plans.product import Settings
from floe.queries.cellwise import geo, latitude_sql
from floe.queries.fixtures import CLASS_AFFINE, Tables
from floe.queries.joins import _EDGE
from floe.queries.learning import _NEAREST, _TRAIN, training_rows
from floe.queries.registry import query, r4
from floe.queries.sources import outlines
from floe.schema import PALETTE, PALETTE_DEFAULT
from floe.session import shared_dir
from floe.sources.products import publish, read_published

WIDTHS, FACTOR, SEGMENTS, ROUNDS = (5, 9, 13), 2, 60, 2
# both scenes lie off the pair's grid, by these parts of a cell (rows, columns)
OFFSETS = {1: (0.25, 0.5), 2: (0.75, 0.25)}


def _bilinear(side: int, value: str) -> str:
    dy, dx = OFFSETS[side]
    place = f"""SELECT s.scene_id, s.row, s.col, CASE WHEN ok THEN least(greatest(s.row + {dy}, 0), h - 1.0) END AS fr, CASE WHEN ok THEN least(greatest(s.col + {dx}, 0), w - 1.0) END AS fc
      FROM (SELECT s.*, h, w, s.row + 0.5 + {dy} < h AND s.col + 0.5 + {dx} < w AS ok FROM fx_site s JOIN g USING (scene_id)) s"""
    corners = {"00": ("0", "0", "(1 - u) * (1 - v)"), "01": ("0", "1", "(1 - u) * v"), "10": ("1", "0", "u * (1 - v)"), "11": ("1", "1", "u * v")}
    joins = " ".join(f"LEFT JOIN fx_site n{k} ON n{k}.scene_id = p.scene_id AND n{k}.row = ar + {i} AND n{k}.col = ac + {j}" for k, (i, j, _) in corners.items())
    total = " + ".join(f"coalesce(n{k}.{value} * ({w}), 0)" for k, (_, _, w) in corners.items())
    weight = " + ".join(f"CASE WHEN n{k}.{value} IS NULL THEN 0 ELSE {w} END" for k, (_, _, w) in corners.items())
    return f"""SELECT p.scene_id, p.row, p.col, CASE WHEN {weight} > 0 THEN ({total}) / ({weight}) END AS v
      FROM (SELECT *, floor(fr) AS ar, floor(fc) AS ac, fr - floor(fr) AS u, fc - floor(fc) AS v FROM ({place})) p {joins}"""


def _inside(cells: str, edges: str) -> str:
    return f"""SELECT DISTINCT scene_id, row, col FROM (SELECT c.scene_id, c.row, c.col, e.poly_id, count(*) AS n FROM {cells} c JOIN {edges} e ON e.scene_id = c.scene_id
      AND (e.y1 > c.row + 0.5) <> (e.y2 > c.row + 0.5) AND c.col + 0.5 < e.x1 + (c.row + 0.5 - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1) GROUP BY ALL) WHERE n % 2 = 1"""


def _window(cells: str, values: str, k: int, columns: list[str], nearest: bool) -> str:
    """Masked means of a k-cell window around cells, each against every offset."""
    half = k // 2
    at = lambda c, n: f"least(greatest(q.{c} + {n}, 0), q.{'h' if c == 'row' else 'w'} - 1)" if nearest else f"q.{c} + {n}"
    means = ", ".join(f"CASE WHEN count(s.{c}) > 0 AND count(s.{c}) >= 0.8 * {k * k} THEN sum(s.{c}) / count(s.{c}) END AS {c}" for c in columns)
    return f"""SELECT q.scene_id, q.row, q.col, {means} FROM (SELECT *, unnest(range({-half}, {half + 1})) AS j FROM (SELECT c.scene_id, c.row, c.col, h, w, unnest(range({-half}, {half + 1})) AS i FROM {cells} c JOIN g USING (scene_id))) q
      JOIN {values} s ON s.scene_id = q.scene_id AND s.row = {at('row', 'i')} AND s.col = {at('col', 'j')} GROUP BY ALL"""


def _texture(n: int, k: int) -> str:
    spread = lambda v: f"sqrt(greatest(m.{v}2 - m.{v} * m.{v}, 0))"
    both = lambda v: f"CASE WHEN m.{v}2 IS NOT NULL AND m.{v} IS NOT NULL THEN {spread(v)} END"
    return f"""m{n} AS MATERIALIZED ({_window('al', 'al', k, ['a', 'b', 'a2', 'b2'], True)}),
    st{n} AS MATERIALIZED (SELECT scene_id, row, col, (c.a - m.a) * (c.b - m.b) AS cross_, pow(({both('a')} + {both('b')}) / 2, 2) AS power_ FROM al c JOIN m{n} m USING (scene_id, row, col)),
    num{n} AS MATERIALIZED ({_window('few', f'st{n}', k, ['cross_'], False)}), den{n} AS MATERIALIZED ({_window('few', f'st{n}', k, ['power_'], True)}),
    t{n} AS (SELECT f.scene_id, f.row, f.col, CASE WHEN d.power_ > 1e-12 AND c.a IS NOT NULL AND c.b IS NOT NULL THEN n.cross_ / d.power_ END AS t
      FROM few f JOIN al c USING (scene_id, row, col) LEFT JOIN num{n} n USING (scene_id, row, col) LEFT JOIN den{n} d USING (scene_id, row, col))"""


def _superpixels() -> str:
    square = lambda c: f"(c.{c} - s.{c}) * (c.{c} - s.{c})"
    distance = f"round({square('r')} + {square('g')} + {square('b')} + ({square('row')} + {square('col')}) * c.pull, 9)"
    means = ", ".join(f"avg({c}) AS {c}" for c in ("row", "col", "r", "g", "b"))
    assign = lambda seeds: f"""SELECT c.scene_id, c.row, c.col, c.r, c.g, c.b, arg_min(s.id, ({distance}, s.id)) AS id FROM home c JOIN {seeds} s
      ON s.scene_id = c.scene_id AND s.sy BETWEEN c.sy - 1 AND c.sy + 1 AND s.sx BETWEEN c.sx - 1 AND c.sx + 1 GROUP BY ALL"""
    parts = [
        f"""home AS MATERIALIZED (SELECT *, (5.0 / sp) * (5.0 / sp) AS pull, CAST(floor((row + 0.5) / sp) AS BIGINT) AS sy, CAST(floor((col + 0.5) / sp) AS BIGINT) AS sx
          FROM (SELECT e.*, mw, greatest(sqrt(mh * mw / {SEGMENTS}.0), 1) AS sp FROM enc e JOIN g USING (scene_id)) WHERE valid)""",
        f"s0 AS MATERIALIZED (SELECT scene_id, sy, sx, sy * CAST(ceil(any_value(mw) / any_value(sp)) AS BIGINT) + sx + 1 AS id, {means} FROM home GROUP BY scene_id, sy, sx)",
    ]
    for k in range(ROUNDS):
        parts.append(f"a{k} AS MATERIALIZED ({assign(f's{k}')})")
        parts.append(f"s{k + 1} AS MATERIALIZED (SELECT s0.sy, s0.sx, m.* FROM (SELECT scene_id, id, {means} FROM a{k} GROUP BY scene_id, id) m JOIN s0 ON s0.scene_id = m.scene_id AND s0.id = m.id)")
    return ",\n".join([*parts, f"seg AS MATERIALIZED ({assign(f's{ROUNDS}')})"])


def _area(x: str, y: str, cell: str) -> str:
    phi = latitude_sql(x, y)
    k = f"(sqrt({x} * {x} + {y} * {y}) / ({geo.A_WGS84!r} * cos({phi}) / sqrt(1 - {geo.E2!r} * sin({phi}) * sin({phi}))))"
    return f"({cell} / ({k} * {k}))"


def _channel(k: int) -> str:
    return "CASE cls " + " ".join(f"WHEN {code} THEN {colour[k]}" for code, colour in PALETTE.items()) + f" ELSE {PALETTE_DEFAULT[k]} END"


_SCALED = ", ".join(f"{c} * {m} / {n} AS {c}" for c, m, n in (("x1", "mw", "w"), ("y1", "mh", "h"), ("x2", "mw", "w"), ("y2", "mh", "h")))
_ENCODED = ", ".join(f"CASE WHEN valid THEN CAST(round_even(least(greatest((t{n} + 0.5) / 1.5, 0), 1) * 255, 0) AS BIGINT) ELSE 0 END AS {c}" for n, c in enumerate("rgb", 1))
_X, _Y = f"({CLASS_AFFINE.c!r} + 4000.0 * scene_id + (col + 0.5) * (res * w / mw))", f"({CLASS_AFFINE.f!r} - (row + 0.5) * (res * h / mh))"
_SUM = lambda r, g, b, alpha: f"CAST(sum({r} + 3 * ({g}) + 7 * ({b}) + 11 * ({alpha})) AS BIGINT)"

_SQL = f"""
WITH g AS MATERIALIZED (SELECT *, (h + 1) // 2 AS mh, (w + 1) // 2 AS mw, 40.0 + 20.0 * scene_id AS res FROM (SELECT scene_id, max(row) + 1 AS h, max(col) + 1 AS w FROM fx_site GROUP BY scene_id)),
edge AS MATERIALIZED (SELECT g.scene_id, h, w, mh, mw, e.poly_id, e.x1, e.y1, e.x2, e.y2 FROM ({_EDGE}) e, g),
ex AS MATERIALIZED ({_inside('fx_site', 'edge')}),
al AS MATERIALIZED (SELECT *, a * a AS a2, b * b AS b2 FROM (SELECT s.scene_id, s.row, s.col, CASE WHEN e.row IS NULL THEN a.v END AS a, CASE WHEN e.row IS NULL THEN b.v END AS b FROM fx_site s
  JOIN ({_bilinear(1, 'a')}) a ON a.scene_id = s.scene_id AND a.row = s.row AND a.col = s.col JOIN ({_bilinear(2, 'b')}) b ON b.scene_id = s.scene_id AND b.row = s.row AND b.col = s.col
  LEFT JOIN ex e ON e.scene_id = s.scene_id AND e.row = s.row AND e.col = s.col)),
few AS MATERIALIZED (SELECT scene_id, orow, ocol, (2 * orow + 1) * h // (2 * mh) AS row, (2 * ocol + 1) * w // (2 * mw) AS col FROM (SELECT g.*, unnest(range(mh)) AS orow FROM g) r, range(0, 1000) c(ocol) WHERE ocol < mw),
{", ".join(_texture(n, k) for n, k in enumerate(WIDTHS, 1))},
enc AS MATERIALIZED (SELECT scene_id, orow AS row, ocol AS col, valid, {_ENCODED} FROM (SELECT f.scene_id, orow, ocol, t1.t AS t1, t2.t AS t2, t3.t AS t3, t1.t IS NOT NULL AND t2.t IS NOT NULL AND t3.t IS NOT NULL AS valid
  FROM few f JOIN t1 USING (scene_id, row, col) JOIN t2 USING (scene_id, row, col) JOIN t3 USING (scene_id, row, col))),
{_superpixels()},
cedge AS MATERIALIZED (SELECT scene_id, poly_id, {_SCALED} FROM edge),
cex AS MATERIALIZED ({_inside('enc', 'cedge')}),
x AS (SELECT scene_id, id AS segment_id, avg(r) AS r, avg(g) AS g, avg(b) AS b FROM seg GROUP BY ALL),
m AS (SELECT label, avg(r) AS r, avg(g) AS g, avg(b) AS b FROM ({_TRAIN}) GROUP BY label),
p AS (SELECT * FROM (SELECT x.scene_id, x.segment_id, m.label, row_number() OVER (PARTITION BY x.scene_id, x.segment_id ORDER BY {_NEAREST}, m.label) AS k FROM x, m) WHERE k = 1),
c AS (SELECT e.*, h, w, mh, mw, res, coalesce(seg.id, 0) AS segment_id, cex.row IS NOT NULL AS excluded,
    CASE WHEN cex.row IS NOT NULL THEN 1 WHEN NOT e.valid OR seg.id IS NULL THEN 255 ELSE coalesce(p.label, 255) END AS cls
  FROM enc e JOIN g ON g.scene_id = e.scene_id LEFT JOIN seg ON seg.scene_id = e.scene_id AND seg.row = e.row AND seg.col = e.col
  LEFT JOIN cex ON cex.scene_id = e.scene_id AND cex.row = e.row AND cex.col = e.col LEFT JOIN p ON p.scene_id = e.scene_id AND p.segment_id = seg.id),
f AS (SELECT *, {_area(_X, _Y, '(res * w / mw) * (res * h / mh) / 1e6')} AS area FROM c),
r AS (SELECT scene_id, count(*) AS cells, count(*) FILTER (excluded) AS excluded_cells, count(*) FILTER (cls = 255) AS unknown_cells, count(DISTINCT nullif(segment_id, 0)) AS segments,
    round(sum(CASE WHEN cls IN (2, 3) THEN area ELSE 0 END), 4) AS ice_km2, round(sum(CASE WHEN cls IN (0, 2, 3) THEN area ELSE 0 END), 4) AS observed_km2,
    {_SUM(*(f"CASE WHEN excluded THEN {PALETTE[1][i]} ELSE {c} END" for i, c in enumerate('rgb')), "CASE WHEN valid OR excluded THEN 255 ELSE 0 END")} AS composite,
    {_SUM(*(_channel(k) for k in range(3)), "CASE WHEN cls = 255 THEN 0 ELSE 255 END")} AS colour FROM f GROUP BY scene_id)
SELECT 'pair-' || r_regionkey::VARCHAR AS pair_id, CASE WHEN r_regionkey < 3 THEN 'process' WHEN r_regionkey = 3 THEN 'reuse' ELSE 'conflict' END AS action,
  r.* EXCLUDE (scene_id) FROM region LEFT JOIN r ON r.scene_id = r_regionkey"""


@query("b2_whole_pair_product", _SQL)
def b2_whole(t: Tables):
    """Five candidates: three to process on grids of different shape and cell size, one stored already, one stored under another fingerprint."""
    key = F.col("r_regionkey")
    name = F.concat(F.lit("pair-"), key.cast("string")).alias("pair_id")
    image = lambda side: F.sha2(F.concat_ws("/", F.lit(str(side)), key.cast("string")), 256)
    identity = fingerprint(image(1), image(2), F.lit("code-1"), F.create_map(F.lit("mask"), F.lit("7")), F.lit("{}"))
    pairs = t.region.select(name, identity.alias("fingerprint"), (key % 3).alias("grid_id"))
    shapes = t.fx_site.groupBy(F.col("scene_id").cast("bigint").alias("grid_id")).agg((F.max("row") + 1).alias("height"), (F.max("col") + 1).alias("width"))
    res = F.lit(40.0) + 20.0 * F.col("grid_id")
    grids = shapes.select("grid_id", res.alias("a"), (F.lit(CLASS_AFFINE.c) + 4000.0 * F.col("grid_id")).alias("c"), (-res).alias("e"), F.lit(CLASS_AFFINE.f).alias("f"), "height", "width")
    sides = F.explode(F.array(*[F.struct(F.lit(s).alias("side"), F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for s, (dy, dx) in OFFSETS.items()]))
    sources = pairs.join(grids, "grid_id").select("*", sides.alias("o")).select(
        "pair_id", "o.side", "a", (F.col("c") - F.col("o.dx") * F.col("a")).alias("c"), "e", (F.col("f") - F.col("o.dy") * F.col("e")).alias("f"), "height", "width"
    )
    values = F.explode(F.array(F.struct(F.lit(1).alias("side"), F.col("a").alias("value")), F.struct(F.lit(2).alias("side"), F.col("b").alias("value"))))
    cells = t.fx_site.select(F.concat(F.lit("pair-"), F.col("scene_id").cast("string")).alias("pair_id"), "row", "col", values.alias("v")).select("pair_id", "row", "col", "v.*")
    cells = cells.withColumn("value", F.col("value").cast("double"))
    drawn = polygon_edges(outlines(t).filter("surface <> 'ocean'"), ["poly_id"]).withColumn("grid_id", F.explode(F.array(*[F.lit(k).cast("bigint") for k in range(3)]))).join(F.broadcast(grids), "grid_id")
    shift = lambda v, c, a: (F.col(c) + F.col(v) * F.col(a)).alias(v)
    edges = drawn.select("grid_id", "poly_id", shift("x1", "c", "a"), shift("y1", "f", "e"), shift("x2", "c", "a"), shift("y2", "f", "e"))
    root = f"{shared_dir(t.spark)}/store-{uuid.uuid4().hex}"
    old = F.when(F.col("pair_id") == "pair-3", F.col("fingerprint")).otherwise(F.lit("an older one"))
    publish(pairs.filter("pair_id in ('pair-3', 'pair-4')").select("pair_id", old.alias("fingerprint")), root)
    settings = Settings(widths=WIDTHS, tile=32, downsample=FACTOR, n_segments=SEGMENTS, rounds=ROUNDS)
    outcome = make_products(pairs, grids, sources, cells, edges, classify.centroids(training_rows(t)), settings, root)
    made = read_published(t.spark, root).filter("cls is not null").withColumnRenamed("pair_id", "scene_id")
    total = lambda c, n: F.sum(F.col(f"{c}.r") + 3 * F.col(f"{c}.g") + 7 * F.col(f"{c}.b") + 11 * F.col(f"{c}.alpha")).alias(n)
    extra = [
        F.count("*").alias("cells"), F.count(F.when(F.col("excluded"), 1)).alias("excluded_cells"), F.countDistinct(F.when(F.col("segment_id") > 0, F.col("segment_id"))).alias("segments"),
        total("composite", "composite"), total("colour", "colour"),
    ]
    found = extent_metrics(made, ["scene_id"], extra=extra).withColumnRenamed("scene_id", "pair_id")
    return outcome.select("pair_id", "action").join(found, "pair_id", "left").select(
        "pair_id", "action", "cells", "excluded_cells", "unknown_cells", "segments", r4("ice_km2").alias("ice_km2"), r4("observed_km2").alias("observed_km2"), "composite", "colour"
    )
