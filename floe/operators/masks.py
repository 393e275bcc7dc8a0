"""Polygons against grids: scanline masks, conservative masks, clipping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from floe.functions import rings
from floe.schema import SURFACES, Affine

SPAN_BLOCK = 256


def polygon_edges(polygons: DataFrame, keys: list[str]) -> DataFrame:
    """Ring column ``ring`` to one row per edge ``x1, y1, x2, y2``."""
    pairs = rings.let(rings.open_ring(F.col("ring")), rings.ring_edges)
    edges = polygons.filter(F.size("ring") >= 3).select(*keys, F.explode(pairs).alias("e"))
    return edges.select(
        *keys, F.col("e.p.x").alias("x1"), F.col("e.p.y").alias("y1"), F.col("e.q.x").alias("x2"), F.col("e.q.y").alias("y2")
    )


def crossing_polygons(polygons: DataFrame, key: str = "poly_id") -> DataFrame:
    """Keys of polygons with a ring whose edges cross each other.

    Edges are filed under the squares they pass through, a typical edge length wide, and
    only edges in one square are compared, so the work follows the outline's length and
    not the square of its vertex count.
    """
    r = F.col("ring")
    pairs = rings.let(rings.open_ring(r), rings.ring_edges)
    length = lambda e: F.hypot(e["q"]["x"] - e["p"]["x"], e["q"]["y"] - e["p"]["y"])

    def measured(edges: Column) -> Column:
        lengths = F.filter(F.transform(edges, length), lambda v: v > 0)
        middle = rings.let(F.array_sort(lengths), lambda v: F.try_element_at(v, (F.size(v) / 2 + 1).cast("int")))
        return F.struct(edges.alias("edges"), middle.alias("size"))

    listed = polygons.filter(F.size(r) >= 4).select(key, F.xxhash64("ring").alias("ring_key"), F.explode(F.array(rings.let(pairs, measured))).alias("m"))
    numbered = listed.select(key, "ring_key", F.col("m.size").alias("size"), F.posexplode("m.edges").alias("k", "e"))
    scaled = numbered.select(
        key, "ring_key", "k", "size", F.col("e.p.x").alias("x1"), F.col("e.p.y").alias("y1"), F.col("e.q.x").alias("x2"), F.col("e.q.y").alias("y2")
    ).filter("size > 0 and (x1 <> x2 or y1 <> y2)")
    unit = lambda c: F.col(c) / F.col("size")
    scaled = scaled.withColumns({"u1": unit("x1"), "v1": unit("y1"), "u2": unit("x2"), "v2": unit("y2")})
    low, high = F.floor(F.least("v1", "v2")), F.floor(F.greatest("v1", "v2"))
    strips = scaled.withColumn("row", F.explode(F.sequence(low, high)))
    left, right = _reach_in_row()
    filed = strips.withColumn("col", F.explode(F.sequence(F.floor(left), F.floor(right)))).drop("u1", "v1", "u2", "v2", "size")
    a, b = filed.alias("a"), filed.alias("b")
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in (key, "ring_key", "row", "col")]
    met = a.join(b, [*same, F.col("a.k") < F.col("b.k")])

    def side(e: str, o: str, end: str) -> Column:
        g = lambda n: F.col(f"{e}.{n}")
        p = lambda n: F.col(f"{o}.{n}{end}")
        return (g("x2") - g("x1")) * (p("y") - g("y1")) - (g("y2") - g("y1")) * (p("x") - g("x1"))

    apart = lambda e, o: side(e, o, "1") * side(e, o, "2") < 0
    return met.filter(apart("a", "b") & apart("b", "a")).select(F.col(f"a.{key}").alias(key)).distinct()


def refuse_crossing(polygons: DataFrame, key: str = "poly_id") -> DataFrame:
    """The same polygons; the job fails at one that crosses itself, for repair belongs to the source."""
    bad = crossing_polygons(polygons, key).withColumn("crossing", F.lit(True))
    broken = F.raise_error(F.concat(F.lit("invalid polygon: "), F.col(key).cast("string")))
    checked = polygons.join(bad, key, "left")
    return checked.withColumn("ring", F.when(F.col("crossing"), broken).otherwise(F.col("ring"))).select(*polygons.columns)


def _reach_in_row() -> tuple[Column, Column]:
    """Lowest and highest u of an edge ``u1, v1, u2, v2`` inside the unit strip ``row``."""

    def at(v: Column) -> Column:
        slope = (F.col("u2") - F.col("u1")) / (F.col("v2") - F.col("v1"))
        return F.col("u1") + (v - F.col("v1")) * slope

    flat = F.col("v1") == F.col("v2")
    top = F.greatest(F.least("v1", "v2"), F.col("row").cast("double"))
    bottom = F.least(F.greatest("v1", "v2"), F.col("row") + 1.0)
    ua = F.when(flat, F.col("u1")).otherwise(at(top))
    ub = F.when(flat, F.col("u2")).otherwise(at(bottom))
    return F.least(ua, ub), F.greatest(ua, ub)


def _cell_units(edges: DataFrame, affine: Affine) -> DataFrame:
    """Edges in cell units (u across columns, v down rows)."""
    if affine.b or affine.d:
        raise ValueError("masks need a grid without rotation")
    u = lambda x: (F.col(x) - affine.c) / affine.a
    v = lambda y: (F.col(y) - affine.f) / affine.e
    return edges.withColumns({"u1": u("x1"), "v1": v("y1"), "u2": u("x2"), "v2": v("y2")}).drop("x1", "y1", "x2", "y2")


def _spans(df: DataFrame, keys: list[str], low: Column, high: Column) -> DataFrame:
    """Clip spans to the grid and drop empty ones."""
    clipped = df.select(
        *keys, "row", F.greatest(low.cast("bigint"), F.lit(0)).alias("lo"), F.least(high.cast("bigint"), F.col("width") - 1).alias("hi")
    )
    return clipped.filter("lo <= hi")


def _rows(edges: DataFrame, low: Column, high: Column) -> DataFrame:
    """One row per grid row an edge concerns; edges outside the grid vanish before the explode."""
    bounded = edges.withColumns(
        {
            "r_lo": F.greatest(low.cast("bigint"), F.lit(0)),
            "r_hi": F.least(high.cast("bigint"), F.col("height") - 1),
        }
    ).filter("r_lo <= r_hi")
    return bounded.withColumn("row", F.explode(F.sequence("r_lo", "r_hi")))


def centre_spans(edges: DataFrame, affine: Affine, keys: list[str], poly: str = "poly_id") -> DataFrame:
    """Row spans of cells whose centre lies inside a polygon (even-odd rule over all its rings).

    ``edges`` carries the grid's ``height, width``. Each edge meets each scan line
    once; sorted crossings of one polygon on one line pair up into spans. Work grows
    with edges times rows they cross, never with cells times edges.
    """
    e = _cell_units(edges, affine)
    v_low, v_high = F.least("v1", "v2"), F.greatest("v1", "v2")
    lines = _rows(e, F.ceil(v_low - 0.5), F.ceil(v_high - 0.5) - 1)
    centre = F.col("row") + 0.5
    crossing = F.col("u1") + (centre - F.col("v1")) * (F.col("u2") - F.col("u1")) / (F.col("v2") - F.col("v1"))
    order = Window.partitionBy(*keys, poly, "row").orderBy("u")
    # by grid row, also for the windows that merge spans: a grid's crossings never meet in one task
    paired = (
        lines.select(*keys, poly, "row", "width", crossing.alias("u"))
        .repartition(*keys, "row")
        .withColumns({"k": F.row_number().over(order), "u_next": F.lead("u").over(order)})
        .filter("k % 2 = 1")
    )
    return _spans(paired, keys, F.ceil(F.col("u") - 0.5), F.ceil(F.col("u_next") - 0.5) - 1)


def touch_spans(edges: DataFrame, affine: Affine, keys: list[str]) -> DataFrame:
    """Row spans of cells that polygon edges pass through (a cell owns its left and top border)."""
    e = _cell_units(edges, affine)
    lines = _rows(e, F.floor(F.least("v1", "v2")), F.floor(F.greatest("v1", "v2")))
    left, right = _reach_in_row()
    return _spans(lines, keys, F.floor(left), F.floor(right))


def merge_spans(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Union of spans per row: disjoint, so a cell meets at most one."""
    order = Window.partitionBy(*keys, "row").orderBy("lo", "hi")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    opened = spans.withColumn("opens", F.coalesce(F.max("hi").over(before) < F.col("lo") - 1, F.lit(True)).cast("int"))
    run = opened.withColumn("run", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return run.groupBy(*keys, "row", "run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("run")


def rasterize_mask(edges: DataFrame, affine: Affine, keys: list[str], all_touched: bool = False, poly: str = "poly_id") -> DataFrame:
    """Mask of polygons on a grid as disjoint row spans ``keys, row, lo, hi``.

    A mask depends on the grid alone: build it once and use it for every scene.
    """
    spans = centre_spans(edges, affine, keys, poly)
    if all_touched:
        spans = spans.unionByName(touch_spans(edges, affine, keys))
    return merge_spans(spans, keys)


def mark_cells(cells: DataFrame, spans: DataFrame, keys: list[str], out: str = "excluded") -> DataFrame:
    """Cells with a flag whether a span covers them; no span at all means nowhere.

    Spans are listed under the column blocks they touch, which makes the match an
    equi-join on (row, block) with a range test on at most a few spans.
    """
    block = lambda c: F.floor(c / SPAN_BLOCK)
    listed = spans.withColumn("block", F.explode(F.sequence(block(F.col("lo")), block(F.col("hi")))))
    listed = listed.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("row").alias("_row"), F.col("block").alias("_block"), "lo", "hi")
    match = (F.col("row") == F.col("_row")) & (block(F.col("col")) == F.col("_block")) & F.col("col").between(F.col("lo"), F.col("hi"))
    for k in keys:
        match = match & (F.col(k) == F.col(f"_{k}"))
    joined = cells.join(listed, match, "left")
    return joined.select(*cells.columns, F.col("lo").isNotNull().alias(out))


def clip_polygons(polygons: DataFrame, west: float, south: float, east: float, north: float, margin: float = 0.0) -> DataFrame:
    """Polygons of the four surfaces inside a box with margin, clipped in their own plane.

    Whole polygons are dropped by their bounding box first; clip before reprojecting.
    """
    w, s, e, n = west - margin, south - margin, east + margin, north + margin
    xs, ys = F.transform("ring", lambda p: p["x"]), F.transform("ring", lambda p: p["y"])
    near = (F.array_max(xs) >= w) & (F.array_min(xs) <= e) & (F.array_max(ys) >= s) & (F.array_min(ys) <= n)
    kept = polygons.filter(F.col("surface").isin(*SURFACES) & near)
    opened = kept.withColumn("ring", rings.open_ring(F.col("ring")))
    clipped = rings.once(refuse_crossing(opened), ring=rings.clip_box(F.col("ring"), w, s, e, n))
    return clipped.filter((F.size("ring") >= 3) & (rings.area(F.col("ring")) > 0))


def surface_counts(polygons: DataFrame) -> DataFrame:
    """Polygons per surface, of whatever rings are passed (before or after clipping); parts and holes count with their polygon."""
    return polygons.groupBy("surface").agg(F.countDistinct("poly_id").alias("polygons"))


def total_bounds(polygons: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Bounding box over all vertices."""
    reach = lambda pick, axis: pick(F.transform("ring", lambda p: p[axis]))
    per_ring = polygons.select(
        *(keys or []),
        reach(F.array_min, "x").alias("x0"),
        reach(F.array_min, "y").alias("y0"),
        reach(F.array_max, "x").alias("x1"),
        reach(F.array_max, "y").alias("y1"),
    )
    return per_ring.groupBy(*(keys or [])).agg(
        F.min("x0").alias("west"), F.min("y0").alias("south"), F.max("x1").alias("east"), F.max("y1").alias("north")
    )
