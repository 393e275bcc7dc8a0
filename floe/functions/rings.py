"""Polygon rings as ``array<struct<x,y>>`` columns: edges, area, projection, box clipping.

Rings are open (the closing vertex is implied). Every step is one pass over the ring
in JVM higher-order functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floe.functions.geo import polar_xy


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def box_ring(west: Column, south: Column, east: Column, north: Column) -> Column:
    """Counter-clockwise corner ring of an axis-aligned box."""
    return F.array(point(west, south), point(east, south), point(east, north), point(west, north))


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once: a Column named twice is evaluated twice."""
    return F.element_at(F.transform(F.array(value), use), 1)


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns behind a generator, so that later filters never copy their expressions downwards."""
    packed = F.struct(*[column.alias(name) for name, column in columns.items()])
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(packed)))


def open_ring(ring: Column) -> Column:
    """Drop a repeated closing vertex."""

    def opened(r: Column) -> Column:
        closed = (F.size(r) > 1) & (F.element_at(r, 1) == F.element_at(r, -1))
        return F.when(closed, F.slice(r, 1, F.size(r) - 1)).otherwise(r)

    return let(ring, opened)


def project_ring(ring: Column) -> Column:
    """Vertices to the polar map, vertex by vertex (edges are not densified)."""

    def moved(p: Column) -> Column:
        x, y = polar_xy(p["x"], p["y"])
        return point(x, y)

    return F.transform(ring, moved)


def _following(ring: Column) -> Column:
    """The ring rotated by one, so that position i holds the end of edge i (``ring`` is a plain reference)."""
    return F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))


def ring_edges(ring: Column) -> Column:
    """Edges ``p -> q`` of a ring (``ring`` is a plain reference)."""
    return F.zip_with(ring, _following(ring), lambda p, q: F.struct(p.alias("p"), q.alias("q")))


def _cross(o: Column, p: Column, q: Column) -> Column:
    return (p["x"] - o["x"]) * (q["y"] - o["y"]) - (p["y"] - o["y"]) * (q["x"] - o["x"])


def signed_area(ring: Column) -> Column:
    """Shoelace sum about the first vertex (keeps map-sized coordinates from cancelling)."""

    def shoelace(r: Column) -> Column:
        terms = F.zip_with(r, _following(r), lambda p, q: _cross(r[0], p, q))
        total = F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t)
        return F.when(F.size(r) >= 3, total / 2).otherwise(F.lit(0.0))

    return let(ring, shoelace)


def area(ring: Column) -> Column:
    return F.abs(signed_area(ring))


EMPTY = "array<struct<x:double,y:double>>"


def _clip_half_plane(ring: Column, side, meet) -> Column:
    """Keep the part of a ring where ``side(p) >= 0``; ``meet(p, dp, q, dq)`` is the boundary point between."""
    measured = F.transform(ring, lambda v: F.struct(v.alias("v"), side(v).alias("d")))

    def piece(a: Column, b: Column) -> Column:
        p, q, dp, dq = a["v"], b["v"], a["d"], b["d"]
        return (
            F.when((dp >= 0) & (dq >= 0), F.array(q))
            .when(dp >= 0, F.array(meet(p, dp, q, dq)))
            .when(dq >= 0, F.array(meet(p, dp, q, dq), q))
            .otherwise(F.array().cast(EMPTY))
        )

    return F.flatten(let(measured, lambda m: F.zip_with(m, _following(m), piece)))


def meets_box(ring: Column, west: float, south: float, east: float, north: float) -> Column:
    """Whether an open ring and a closed box have a point in common; touching counts, the ring may be concave.

    Some edge meets the box, or the box lies inside the ring. An edge misses the box if it is beyond one of its
    sides or all four corners are strictly on one side of the edge's line, so nothing is divided.
    """
    w, s, e, n = (F.lit(float(v)) for v in (west, south, east, north))
    box = [point(x, y) for x, y in ((w, s), (e, s), (e, n), (w, n))]

    def meets(edge: Column) -> Column:
        p, q = edge["p"], edge["q"]
        beyond = (F.greatest(p["x"], q["x"]) < w) | (F.least(p["x"], q["x"]) > e) | (F.greatest(p["y"], q["y"]) < s) | (F.least(p["y"], q["y"]) > n)
        sides = [_cross(p, q, corner) for corner in box]
        return ~beyond & (F.least(*sides) <= 0) & (F.greatest(*sides) >= 0)

    def crosses(edge: Column) -> Column:
        """Whether the ray to the east of the box's first corner crosses the edge."""
        p, q = edge["p"], edge["q"]
        side = _cross(p, q, box[0])
        return ((p["y"] > s) != (q["y"] > s)) & (F.when(q["y"] > p["y"], side).otherwise(-side) > 0)

    def judged(edges: Column) -> Column:
        return F.exists(edges, meets) | (F.size(F.filter(edges, crosses)) % 2 == 1)

    return F.coalesce(let(let(ring, ring_edges), judged), F.lit(False))


def clip_box(ring: Column, west: float, south: float, east: float, north: float) -> Column:
    """A ring inside an axis-aligned box; a concave ring keeps its exact area."""

    def along(axis: str, other: str, bound: float, sign: float):
        def meet(p: Column, dp: Column, q: Column, dq: Column) -> Column:
            t = dp / (dp - dq)
            crossing = p[other] + t * (q[other] - p[other])
            return point(F.lit(bound), crossing) if axis == "x" else point(crossing, F.lit(bound))

        return (lambda v: (v[axis] - bound) * sign), meet

    for axis, other, bound, sign in (("x", "y", west, 1.0), ("x", "y", east, -1.0), ("y", "x", south, 1.0), ("y", "x", north, -1.0)):
        ring = _clip_half_plane(ring, *along(axis, other, float(bound), sign))
    return ring

