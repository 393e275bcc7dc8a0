"""Pairs, orbits, masks, resampling and other joins."""

from pyspark.sql import functions as F

from floe.operators import cells as grids
from floe.operators import masks
from floe.operators.orbits import match_orbits, unordered_vectors
from floe.operators.pairs import compatible_pairs, select_pairs
from floe.operators.training import duplicate_scenes, label_segments, unused_annotations
from floe.operators.zonal import paint_segments, segment_features
from floe.plans.product import grid_edges
from floe.queries.cellwise import polar_sql
from floe.queries.fixtures import DAVIS, SCENE_OUTLINES, UNIT_AFFINE, Tables, scene_of
from floe.operators.checks import numbered
from floe.queries.registry import query, r4
from floe.queries.sources import outline_lines, outlines, scenes
from floe.schema import Affine, PairRules
from floe.sources.polygons import parse_polygons

RULES = PairRules(polarization="HH", min_days=3, max_days=24, min_overlap=0.25)

# Boxes compared in their own lon/lat plane have an exact overlap in SQL.
_PAIRS = """
SELECT * FROM (
SELECT a.file_id AS first_id, b.file_id AS second_id, a.start_time AS t1, b.start_time AS t2,
  concat(strftime(a.start_time, '%Y%m%dT%H%M%S'), '_', strftime(b.start_time, '%Y%m%dT%H%M%S'), '_',
    substr(sha256(concat(CAST(a.file_id AS VARCHAR), '|', CAST(b.file_id AS VARCHAR))), 1, 8)) AS pair_id,
  date_diff('microsecond', a.start_time, b.start_time) / 86400e6 AS baseline_days,
  greatest(least(a.east, b.east, 80.5) - greatest(a.west, b.west, 75.5), 0)
    * greatest(least(a.north, b.north, -67.3) - greatest(a.south, b.south, -69.2), 0) / (5.0 * 1.9) AS fraction
FROM fx_cat a JOIN fx_cat b ON a.path_number = b.path_number AND a.flight_direction = b.flight_direction
  AND a.beam_mode = b.beam_mode AND a.polarization = b.polarization
WHERE list_contains(string_split(a.polarization, '+'), 'HH')
  AND date_diff('microsecond', a.start_time, b.start_time) BETWEEN 3 * 86400000000 AND 24 * 86400000000)
WHERE fraction >= 0.25"""


def lonlat_pairs(t: Tables):
    return compatible_pairs(scenes(t), DAVIS, RULES, project=False)


@query(
    "j1_compatible_pairs",
    f"SELECT pair_id, first_id, second_id, round(baseline_days, 6) AS baseline_days, round(fraction, 6) AS common_aoi_fraction FROM ({_PAIRS})",
)
def j1(t: Tables):
    pairs = lonlat_pairs(t)
    return pairs.select("pair_id", "first_id", "second_id", r4("baseline_days", 6).alias("baseline_days"), r4("common_aoi_fraction", 6).alias("common_aoi_fraction"))


_ORDERED = ["second_time", "baseline_days", "pair_id"]


@query("o1_pair_order", f"SELECT pair_id, CAST(row_number() OVER (ORDER BY t2, baseline_days, pair_id) AS BIGINT) AS position FROM ({_PAIRS})")
def o1(t: Tables):
    """The whole ordered list, numbered: the order itself is the result."""
    return numbered(lonlat_pairs(t).select(*_ORDERED), "second_time", _ORDERED).select("pair_id", "position")


@query("o2_pair_slice", f"SELECT pair_id FROM ({_PAIRS}) ORDER BY t2, baseline_days, pair_id LIMIT 40 OFFSET 25")
def o2(t: Tables):
    return select_pairs(lonlat_pairs(t), 25, 40).select("pair_id")


def _frame_sql(west, south, east, north):
    """A box's corners on the polar map, counter-clockwise there."""
    return [polar_sql(x, y) for x, y in ((west, south), (west, north), (east, north), (east, south))]


# Overlap of two trapezoids and the area of interest on the polar map. Corner k of a ring lies in
# all rings, or two edges cross inside the third: sorted about their centre these are the vertices.
_AOI = _frame_sql(*map(str, DAVIS))
_POLAR = f"""
WITH p AS ({_PAIRS.replace("fraction >= 0.25", "fraction >= 0")}),
ring AS (SELECT file_id, unnest([0, 1, 2, 3]) AS k, unnest([west, west, east, east]) AS lon, unnest([south, north, north, south]) AS lat FROM fx_cat),
xy AS (SELECT file_id, k, {polar_sql('lon', 'lat')[0]} AS x, {polar_sql('lon', 'lat')[1]} AS y FROM ring),
edge AS (SELECT a.file_id, a.k, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM xy a JOIN xy b ON a.file_id = b.file_id AND b.k = (a.k + 1) % 4),
aoi AS (SELECT * FROM (VALUES {", ".join(f"({k}, {x}, {y})" for k, (x, y) in enumerate(_AOI))}) v(k, x, y)),
aoi_edge AS (SELECT a.k, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM aoi a JOIN aoi b ON b.k = (a.k + 1) % 4),
e AS (
  SELECT pair_id, 0 AS ring, k, x1, y1, x2, y2 FROM p JOIN edge ON file_id = first_id
  UNION ALL SELECT pair_id, 1, k, x1, y1, x2, y2 FROM p JOIN edge ON file_id = second_id
  UNION ALL SELECT pair_id, 2, k, x1, y1, x2, y2 FROM p, aoi_edge),
candidate AS (
  SELECT pair_id, x1 AS x, y1 AS y FROM e
  UNION ALL
  SELECT a.pair_id, a.x1 + u * (a.x2 - a.x1), a.y1 + u * (a.y2 - a.y1)
  FROM (SELECT a.*, ((b.x1 - a.x1) * (b.y2 - b.y1) - (b.y1 - a.y1) * (b.x2 - b.x1)) / nullif((a.x2 - a.x1) * (b.y2 - b.y1) - (a.y2 - a.y1) * (b.x2 - b.x1), 0) AS u,
      ((b.x1 - a.x1) * (a.y2 - a.y1) - (b.y1 - a.y1) * (a.x2 - a.x1)) / nullif((a.x2 - a.x1) * (b.y2 - b.y1) - (a.y2 - a.y1) * (b.x2 - b.x1), 0) AS w
    FROM e a JOIN e b ON a.pair_id = b.pair_id AND a.ring < b.ring) a
  WHERE u BETWEEN 0 AND 1 AND w BETWEEN 0 AND 1),
inside AS (
  SELECT c.pair_id, round(c.x, 3) AS x, round(c.y, 3) AS y FROM candidate c JOIN e ON e.pair_id = c.pair_id
  GROUP BY c.pair_id, c.x, c.y
  HAVING min((e.x2 - e.x1) * (c.y - e.y1) - (e.y2 - e.y1) * (c.x - e.x1)) >= -1 OR max((e.x2 - e.x1) * (c.y - e.y1) - (e.y2 - e.y1) * (c.x - e.x1)) <= 1),
corner AS (SELECT DISTINCT pair_id, x, y FROM inside),
turned AS (SELECT *, atan2(y - avg(y) OVER (PARTITION BY pair_id), x - avg(x) OVER (PARTITION BY pair_id)) AS angle,
  x - avg(x) OVER (PARTITION BY pair_id) AS px, y - avg(y) OVER (PARTITION BY pair_id) AS py FROM corner),
nxt AS (SELECT pair_id, px, py, coalesce(lead(px) OVER w, first_value(px) OVER w) AS qx, coalesce(lead(py) OVER w, first_value(py) OVER w) AS qy
  FROM turned WINDOW w AS (PARTITION BY pair_id ORDER BY angle)),
size AS (SELECT pair_id, abs(sum(px * qy - py * qx)) / 2 AS area FROM nxt GROUP BY pair_id),
frame AS (SELECT abs(sum(x1 * y2 - y1 * x2)) / 2 AS area FROM aoi_edge)
SELECT p.pair_id, round(size.area / frame.area, 4) AS common_aoi_fraction FROM p JOIN size ON size.pair_id = p.pair_id, frame
WHERE size.area / frame.area >= 0.25"""


@query("j2_polar_overlap", _POLAR)
def j2(t: Tables):
    pairs = compatible_pairs(scenes(t), DAVIS, RULES)
    return pairs.select("pair_id", r4("common_aoi_fraction").alias("common_aoi_fraction"))


# every odd scene lacks the upper right quarter of its box: what boxes share, less what quarters share with them
def _shared_box(a: str, b: str) -> str:
    low = lambda e, side, mid: f"({e}.west + {e}.east) / 2" if side == "q" and mid == "x" else f"({e}.south + {e}.north) / 2" if side == "q" else f"{e}.west" if mid == "x" else f"{e}.south"
    wide = f"least(a.east, b.east, 80.5) - greatest({low('a', a, 'x')}, {low('b', b, 'x')}, 75.5)"
    high = f"least(a.north, b.north, -67.3) - greatest({low('a', a, 'y')}, {low('b', b, 'y')}, -69.2)"
    return f"greatest({wide}, 0) * greatest({high}, 0)"


_NOTCHED = _PAIRS.replace(
    """greatest(least(a.east, b.east, 80.5) - greatest(a.west, b.west, 75.5), 0)
    * greatest(least(a.north, b.north, -67.3) - greatest(a.south, b.south, -69.2), 0) / (5.0 * 1.9)""",
    f"""({_shared_box("b", "b")} - (a.file_id % 2) * {_shared_box("q", "b")} - (b.file_id % 2) * {_shared_box("b", "q")} + (a.file_id % 2) * (b.file_id % 2) * {_shared_box("q", "q")}) / (5.0 * 1.9)""",
)
assert _NOTCHED != _PAIRS


@query("j2_concave_overlap", f"SELECT pair_id, round(fraction, 6) AS common_aoi_fraction FROM ({_NOTCHED})")
def j2_concave(t: Tables):
    """Pairs among boxes and L-shaped scenes."""
    point = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    w, e, s, n = (F.col(c) for c in ("west", "east", "south", "north"))
    x, y = (w + e) / 2, (s + n) / 2
    ell = F.array(point(w, s), point(e, s), point(e, y), point(x, y), point(x, n), point(w, n))
    shaped = scenes(t).withColumn("footprint", F.when(F.col("file_id") % 2 == 1, ell).otherwise(F.col("footprint")))
    pairs = compatible_pairs(shaped, DAVIS, RULES, project=False)
    return pairs.select("pair_id", r4("common_aoi_fraction", 6).alias("common_aoi_fraction"))


@query(
    "j3_orbit_coverage",
    """
WITH m AS (SELECT s.file_id, s.mission, o.name, o.creation, row_number() OVER (PARTITION BY s.file_id ORDER BY o.creation DESC NULLS LAST, o.name DESC) AS k,
    count(o.name) OVER (PARTITION BY s.file_id) AS candidates
  FROM fx_cat s LEFT JOIN fx_orb o ON o.mission = s.mission AND o.valid_from <= s.start_time - INTERVAL 60 SECOND AND s.stop_time + INTERVAL 60 SECOND <= o.valid_to)
SELECT file_id, mission, name AS orbit_name, candidates, CASE WHEN name IS NULL THEN 'no_orbit' ELSE 'matched' END AS status FROM m WHERE k = 1""",
)
def j3(t: Tables):
    return match_orbits(t.fx_cat, t.fx_orb)


# Brute force: every cell against every edge.
_EDGE = """SELECT v.poly_id, v.surface, v.x AS x1, v.y AS y1, n.x AS x2, n.y AS y2 FROM fx_vertex v
  JOIN fx_vertex n ON n.poly_id = v.poly_id AND n.seq = (v.seq + 1) % 5 WHERE v.surface <> 'ocean'"""
_INSIDE = f"""
  SELECT DISTINCT row, col FROM (
    SELECT c.row, c.col, e.poly_id, count(*) AS n FROM fx_dense c JOIN ({_EDGE}) e
    ON (e.y1 > c.row + 0.5) <> (e.y2 > c.row + 0.5) AND c.col + 0.5 < e.x1 + (c.row + 0.5 - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1)
    GROUP BY ALL) WHERE n % 2 = 1"""
_TOUCHED = f"""
  SELECT DISTINCT c.row, c.col FROM fx_dense c JOIN ({_EDGE}) e
  ON c.row BETWEEN floor(least(e.y1, e.y2)) AND floor(greatest(e.y1, e.y2))
  AND c.col BETWEEN
    floor(CASE WHEN e.y1 = e.y2 THEN least(e.x1, e.x2) ELSE least(e.x1 + (greatest(least(e.y1, e.y2), c.row) - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1),
      e.x1 + (least(greatest(e.y1, e.y2), c.row + 1) - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1)) END)
    AND floor(CASE WHEN e.y1 = e.y2 THEN greatest(e.x1, e.x2) ELSE greatest(e.x1 + (greatest(least(e.y1, e.y2), c.row) - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1),
      e.x1 + (least(greatest(e.y1, e.y2), c.row + 1) - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1)) END)"""


def outline_edges(t: Tables):
    """Edges of the land and shelf outlines with the raster's shape, in cell units."""
    edges = masks.polygon_edges(parse_polygons(outline_lines(t)), ["poly_id"])
    return grid_edges(edges.withColumn("scene_id", scene_of("poly_id", SCENE_OUTLINES)), t.grid())


def marked(t: Tables, all_touched: bool = False):
    spans = masks.rasterize_mask(outline_edges(t), UNIT_AFFINE, ["scene_id"], all_touched)
    return masks.mark_cells(t.fx_dense.withColumn("scene_id", scene_of("row")), spans, ["scene_id"])


# outlines with a rectangular hole, odd ones with a square as second part; corners (x, y) in sizes from the outline's corner
_HOLE, _PART, _PART_AT = ((0.25, 0.25), (0.75, 0.25), (0.75, 0.75), (0.25, 0.75)), ((0.0, 0.0), (0.5, 0.0), (0.5, 0.5), (0.0, 0.5)), 20.0


def _ring_sql(corners, at: float, rule: str) -> str:
    pairs = zip(corners, corners[1:] + corners[:1])
    edges = ", ".join(f"({x1}, {y1}, {x2}, {y2})" for (x1, y1), (x2, y2) in pairs)
    return f"""SELECT poly_id, x0 + {at} + e.a * size AS x1, y0 + e.b * size AS y1, x0 + {at} + e.c * size AS x2, y0 + e.d * size AS y2 FROM fx_outline, (VALUES {edges}) e(a, b, c, d) WHERE surface <> 'ocean' AND {rule}"""


_RINGS = f"SELECT poly_id, x1, y1, x2, y2 FROM ({_EDGE}) UNION ALL {_ring_sql(_HOLE, 0.0, 'true')} UNION ALL {_ring_sql(_PART, _PART_AT, 'poly_id % 2 = 1')}"


@query(
    "s6_unnumbered_features",
    f"""
SELECT c.row, c.col, m.row IS NOT NULL AS excluded FROM fx_dense c LEFT JOIN (SELECT DISTINCT row, col FROM (SELECT c.row, c.col, e.poly_id, count(*) AS n FROM fx_dense c JOIN ({_RINGS}) e
    ON (e.y1 > c.row + 0.5) <> (e.y2 > c.row + 0.5) AND c.col + 0.5 < e.x1 + (c.row + 0.5 - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1) GROUP BY ALL) WHERE n % 2 = 1) m ON m.row = c.row AND m.col = c.col""",
)
def s6_unnumbered(t: Tables):
    """Features without a number, a third of them listed twice, with holes, second parts and overlaps: cells they cover together."""
    closed = lambda corners, at: F.array(*[F.array(F.col("x0") + at + x * F.col("size"), F.col("y0") + y * F.col("size")) for x, y in (*corners, corners[0])])
    outline = closed(((0.0, 0.0), (1.0, 0.0), (1.0, 2.0), (0.5, 1.0), (0.0, 2.0)), 0.0)
    parts = F.array(F.array(outline, closed(_HOLE, 0.0)), F.array(closed(_PART, _PART_AT)))
    odd = F.col("poly_id") % 2 == 1
    coordinates = F.when(odd, F.to_json(parts)).otherwise(F.to_json(parts[0]))
    text = F.concat(
        F.lit('{"properties":{"surface":"'), "surface", F.lit('"},"geometry":{"type":"'), F.when(odd, "MultiPolygon").otherwise("Polygon"), F.lit('","coordinates":'), coordinates, F.lit("}}")
    )
    lines = t.fx_outline.select("poly_id", text.alias("json"))
    lines = lines.unionByName(lines.filter("poly_id % 3 = 0")).drop("poly_id")
    edges = masks.polygon_edges(parse_polygons(lines), ["poly_id"]).withColumn("scene_id", F.lit(0).cast("bigint"))
    spans = masks.rasterize_mask(grid_edges(edges, t.grid()), UNIT_AFFINE, ["scene_id"])
    return masks.mark_cells(t.fx_dense.withColumn("scene_id", scene_of("row")), spans, ["scene_id"]).select("row", "col", "excluded")


@query("j4_polygon_mask", f"SELECT c.row, c.col, m.row IS NOT NULL AS excluded FROM fx_dense c LEFT JOIN ({_INSIDE}) m ON m.row = c.row AND m.col = c.col")
def j4(t: Tables):
    return marked(t).select("row", "col", "excluded")


@query(
    "j5_all_touched_mask",
    f"SELECT c.row, c.col, m.row IS NOT NULL AS excluded FROM fx_dense c LEFT JOIN ({_INSIDE} UNION {_TOUCHED}) m ON m.row = c.row AND m.col = c.col",
)
def j5(t: Tables):
    return marked(t, all_touched=True).select("row", "col", "excluded")


@query(
    "j6_join_cells",
    "SELECT p.row, p.col, p.prev, c.curr FROM (SELECT row, col, prev FROM fx_cls WHERE row % 3 <> 0) p JOIN (SELECT row, col, curr FROM fx_cls WHERE col % 5 <> 0) c ON c.row = p.row AND c.col = p.col",
)
def j6(t: Tables):
    old = t.fx_cls.filter("row % 3 <> 0").select("row", "col", "prev")
    new = t.fx_cls.filter("col % 5 <> 0").select("row", "col", "curr")
    return grids.join_cells(old, new, ["row", "col"])


@query(
    "j7_grid_conflicts",
    "SELECT a.product_id AS first_id, b.product_id AS second_id FROM fx_prod a JOIN fx_prod b ON b.product_id = a.product_id + 1 WHERE a.grid_height <> b.grid_height",
)
def j7(t: Tables):
    frame = F.struct(F.lit("EPSG:3031").alias("crs"), F.lit(40.0).alias("a"), F.col("grid_height").alias("height"), F.lit(900).alias("width"))
    frames = t.fx_prod.select(F.col("product_id").alias("scene_id"), frame.alias("grid"))
    ids = t.fx_prod.select("product_id")
    following = ids.select((F.col("product_id") - 1).alias("first_id"), F.col("product_id").alias("second_id"))
    pairs = following.join(ids.select(F.col("product_id").alias("first_id")), "first_id")
    return grids.grid_conflicts(pairs, frames).select("first_id", "second_id")


@query(
    "j8_paint_segments",
    """SELECT s.row, s.col, s.segment_id, p.predicted FROM fx_seg s LEFT JOIN (SELECT scene_id, segment_id, round(avg(r), 4) AS predicted
 FROM fx_seg WHERE segment_id > 0 GROUP BY ALL) p ON p.scene_id = s.scene_id AND p.segment_id = s.segment_id""",
)
def j8(t: Tables):
    values = segment_features(t.fx_seg).withColumn("predicted", r4("mean_r"))
    return paint_segments(t.fx_seg, values).select("row", "col", "segment_id", "predicted")


@query(
    "j9_label_segments",
    """SELECT s.scene_id, s.segment_id, s.r, s.g, s.b, a.label FROM fx_annseg s JOIN fx_ann a ON a.scene_id = s.scene_id AND a.segment_id = s.segment_id
 WHERE s.segment_id > 0 AND a.label IN (0, 2, 3)""",
)
def j9(t: Tables):
    return label_segments(t.fx_annseg, t.fx_ann)


@query(
    "j10_unused_annotations",
    "SELECT scene_id, segment_id, label FROM fx_ann a WHERE label IS NOT NULL AND NOT EXISTS (SELECT 1 FROM fx_annseg s WHERE s.scene_id = a.scene_id AND s.segment_id = a.segment_id)",
)
def j10(t: Tables):
    return unused_annotations(t.fx_ann, t.fx_annseg)


@query(
    "j11_duplicate_scenes",
    """SELECT scene_no, min(scene_no) OVER (PARTITION BY image_hash) AS first_scene, count(*) OVER (PARTITION BY image_hash) AS copies FROM fx_doc QUALIFY copies > 1""",
)
def j11(t: Tables):
    return duplicate_scenes(t.fx_doc, ["image_hash"], "scene_no").select("scene_no", "first_scene", "copies")


# Regridding: a target grid at 0.8 cell spacing, shifted, whose centres fall between source centres.
_TARGET = """SELECT i AS row, j AS col, 1.37 + (i + 0.5) * 0.8 AS y, -0.93 + (j + 0.5) * 0.8 AS x
  FROM range(0, (SELECT CAST(max(vec_id) + 1 AS BIGINT) FROM embeddings)) a(i), range(0, 84) b(j)"""


def regrid_targets(t: Tables):
    cells = t.embeddings.select(scene_of("vec_id"), F.col("vec_id").alias("row"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(83).cast("bigint"))).alias("col"))
    placed = cells.withColumns({"src_row": 1.37 + (F.col("row") + 0.5) * 0.8, "src_col": -0.93 + (F.col("col") + 0.5) * 0.8})
    return placed.withColumns({"src_height": t.shape().scalar(), "src_width": F.lit(64).cast("bigint")})


def bilinear_sql(value: str) -> str:
    """Four explicit neighbours of every target centre, weights renormalised."""
    return f"""
SELECT m.row, m.col, CASE WHEN x >= 0 AND x < n.w AND y >= 0 AND y < n.h AND m.w > 0 THEN s / m.w END AS {value} FROM (
  SELECT k.row, k.col, any_value(k.x) AS x, any_value(k.y) AS y, sum(k.weight * g.{value}) AS s, sum(CASE WHEN g.{value} IS NOT NULL THEN k.weight END) AS w FROM (
    SELECT t.*, r0 + dr AS r, c0 + dc AS c, (1 - abs(y - 0.5 - (r0 + dr))) * (1 - abs(x - 0.5 - (c0 + dc))) AS weight
    FROM (SELECT row, col, y, x, floor(y - 0.5) AS r0, floor(x - 0.5) AS c0 FROM ({_TARGET})) t, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) o(dr, dc)) k
  LEFT JOIN fx_grid g ON g.row = k.r AND g.col = k.c GROUP BY k.row, k.col) m, (SELECT max(vec_id) + 1 AS h, 64 AS w FROM embeddings) n"""


@query("j19_regrid_bilinear", f"SELECT row, col, round(a, 4) AS a FROM ({bilinear_sql('a')})")
def j19(t: Tables):
    return grids.regrid_bilinear(regrid_targets(t), t.raster(), ["a"], grids=t.grid()).select("row", "col", r4("a").alias("a"))


@query(
    "j20_regrid_nearest",
    f"SELECT t.row, t.col, g.a FROM ({_TARGET}) t LEFT JOIN fx_grid g ON g.row = floor(t.y) AND g.col = floor(t.x)",
)
def j20(t: Tables):
    targets = regrid_targets(t).drop("src_height", "src_width")
    source = t.fx_grid.withColumn("scene_id", scene_of("row"))
    return grids.regrid_nearest(targets, source, ["a"]).select("row", "col", "a")


_SHOW = (77.7, -68.6, 78.0, -68.55)
_SHOWN = grids.display_shape(_SHOW, 120)
_DX, _DY = polar_sql(f"({_SHOW[0]} + (j + 0.5) * {(_SHOW[2] - _SHOW[0]) / _SHOWN[1]!r})", f"({_SHOW[3]} - (i + 0.5) * {(_SHOW[3] - _SHOW[1]) / _SHOWN[0]!r})")
# The class grid drawn 400 m wide, so that the small fixture covers a visible part of the picture.
_WIDE = Affine.north_up(2285000.0, 500000.0, 400.0)


@query(
    "j20_display_image",
    f"""
WITH px AS (SELECT i AS row, j AS col, floor(({_WIDE.f} - {_DY}) / 400) AS sr, floor(({_DX} - {_WIDE.c}) / 400) AS sc FROM range({_SHOWN[0]}) a(i), range({_SHOWN[1]}) b(j))
SELECT px.row, px.col, CASE curr WHEN 0 THEN 15 WHEN 1 THEN 88 WHEN 2 THEN 68 WHEN 3 THEN 240 ELSE 235 END AS r,
  CASE curr WHEN 0 THEN 35 WHEN 1 THEN 94 WHEN 2 THEN 218 WHEN 3 THEN 170 ELSE 235 END AS g,
  CASE curr WHEN 0 THEN 48 WHEN 1 THEN 99 WHEN 2 THEN 100 WHEN 3 THEN 40 ELSE 235 END AS b
FROM px LEFT JOIN fx_cls c ON c.row = sr AND c.col = sc""",
)
def j20_display(t: Tables):
    from floe.functions.encode import class_rgba

    rgba = class_rgba(t.fx_cls, "curr").withColumn("scene_id", scene_of("row"))
    drawn = grids.display_image(rgba, t.grid().select("scene_id"), _WIDE, _SHOW, 120)
    return drawn.select("row", "col", "r", "g", "b")


@query(
    "j21_downsample_nearest",
    """
WITH n AS (SELECT max(vec_id) + 1 AS h, 64 AS w, ceil((max(vec_id) + 1) / 7) AS oh, ceil(64 / 7) AS ow FROM embeddings)
SELECT CAST(i AS BIGINT) AS row, CAST(j AS BIGINT) AS col, g.a, g.b FROM n, range(100000) x(i), range(10) y(j), fx_grid g
WHERE i < oh AND j < ow AND g.row = floor((i + 0.5) * h / oh) AND g.col = floor((j + 0.5) * w / ow)""",
)
def j21(t: Tables):
    return grids.downsample_nearest(t.raster(), 7).select("row", "col", "a", "b")


# what is left of an outline has its corners among these: outline corners in the box, crossings of edges and box sides, box corners in the outline
_CLIP_BOX = "x BETWEEN 10 AND 40 AND y BETWEEN 49.8e0 AND 300.2e0"
_CLIP_SIDES = "(VALUES (10e0), (40e0)) b(x)", "(VALUES (49.8e0), (300.2e0)) b(y)"
_CLIP_CORNERS = "(VALUES (10e0, 49.8e0), (40e0, 49.8e0), (40e0, 300.2e0), (10e0, 300.2e0)) b(x, y)"


@query(
    "j23_clip_polygons",
    f"""
WITH edge AS ({_EDGE}),
corner AS (
  SELECT * FROM (
    SELECT poly_id, surface, x1 AS x, y1 AS y FROM edge
    UNION ALL SELECT poly_id, surface, b.x, y1 + (b.x - x1) * (y2 - y1) / (x2 - x1) FROM edge, {_CLIP_SIDES[0]} WHERE x1 <> x2 AND b.x BETWEEN least(x1, x2) AND greatest(x1, x2)
    UNION ALL SELECT poly_id, surface, x1 + (b.y - y1) * (x2 - x1) / (y2 - y1), b.y FROM edge, {_CLIP_SIDES[1]} WHERE y1 <> y2 AND b.y BETWEEN least(y1, y2) AND greatest(y1, y2)
  ) WHERE {_CLIP_BOX}
  UNION ALL SELECT poly_id, surface, b.x, b.y FROM edge, {_CLIP_CORNERS}
  WHERE (y1 > b.y) <> (y2 > b.y) AND b.x < x1 + (b.y - y1) * (x2 - x1) / (y2 - y1) GROUP BY ALL HAVING count(*) % 2 = 1)
SELECT poly_id, surface, round(max(x) - min(x), 4) AS x_extent FROM corner GROUP BY ALL HAVING max(x) > min(x) AND max(y) > min(y)""",
)
def j23(t: Tables):
    """Width of what the box leaves of each outline; it may be less than the boxes share, for outlines are concave."""
    clipped = masks.clip_polygons(outlines(t), 10.2, 50, 39.8, 300, 0.2)
    bounds = masks.total_bounds(clipped, ["poly_id", "surface"])
    return bounds.select("poly_id", "surface", r4(F.col("east") - F.col("west")).alias("x_extent"))


@query(
    "w4_unordered_vectors",
    "SELECT user_id AS file, event_id AS pos FROM (SELECT *, lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS before FROM events) WHERE before >= value",
)
def w4(t: Tables):
    vectors = t.events.select(F.col("user_id").alias("file"), F.col("event_id").alias("pos"), F.col("value").alias("t"))
    return unordered_vectors(vectors).select("file", "pos")
