"""Polar stereographic projection and grid arithmetic as Spark columns.

Closed forms after Snyder, *Map Projections: A Working Manual* (USGS PP 1395):
WGS84 ellipsoid, south polar aspect, true scale at 71 S, central meridian 0.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floe.schema import Affine

A_WGS84 = 6378137.0
_F = 1 / 298.257223563
E2 = _F * (2 - _F)
ECC = math.sqrt(E2)
_PHI_C = math.radians(71.0)


def _t_value(phi: float) -> float:
    s = ECC * math.sin(phi)
    return math.tan(math.pi / 4 - phi / 2) / ((1 - s) / (1 + s)) ** (ECC / 2)


# rho = RHO_PER_T * t on the whole map
RHO_PER_T = A_WGS84 * (math.cos(_PHI_C) / math.sqrt(1 - E2 * math.sin(_PHI_C) ** 2)) / _t_value(_PHI_C)

# conformal latitude -> geodetic latitude: coefficients of sin(2k chi)
SERIES = (
    E2 / 2 + 5 * E2**2 / 24 + E2**3 / 12 + 13 * E2**4 / 360,
    7 * E2**2 / 48 + 29 * E2**3 / 240 + 811 * E2**4 / 11520,
    7 * E2**3 / 120 + 81 * E2**4 / 1120,
    4279 * E2**4 / 161280,
)


def _col(value: Column | str | float) -> Column:
    if isinstance(value, Column):
        return value
    return F.col(value) if isinstance(value, str) else F.lit(float(value))


def polar_xy(lon: Column | str | float, lat: Column | str | float) -> tuple[Column, Column]:
    """Longitude/latitude in degrees to EPSG:3031 metres."""
    lam = F.radians(_col(lon))
    phi = -F.radians(_col(lat))
    s = ECC * F.sin(phi)
    t = F.tan(math.pi / 4 - phi / 2) / F.pow((1 - s) / (1 + s), F.lit(ECC / 2))
    rho = t * RHO_PER_T
    return rho * F.sin(lam), rho * F.cos(lam)


def _south_latitude(rho: Column) -> Column:
    """Positive geodetic latitude (radians, counted southward) at distance rho from the pole."""
    chi = math.pi / 2 - 2 * F.atan(rho / RHO_PER_T)
    phi = chi
    for k, coefficient in enumerate(SERIES, 1):
        phi = phi + coefficient * F.sin(2 * k * chi)
    return phi


def lonlat(x: Column | str | float, y: Column | str | float) -> tuple[Column, Column]:
    """EPSG:3031 metres to longitude/latitude in degrees."""
    x, y = _col(x), _col(y)
    return F.degrees(F.atan2(x, y)), -F.degrees(_south_latitude(F.hypot(x, y)))


def areal_scale(x: Column | str, y: Column | str) -> Column:
    """Squared point scale factor: projected area over true area."""
    rho = F.hypot(_col(x), _col(y))
    phi = _south_latitude(rho)
    sin_phi = F.sin(phi)
    m = F.cos(phi) / F.sqrt(1 - E2 * sin_phi * sin_phi)
    k = rho / (A_WGS84 * m)
    return k * k


def cell_xy(row: Column | str, col: Column | str, affine: Affine) -> tuple[Column, Column]:
    """Map coordinates of a cell centre, rotation terms included."""
    i, j = _col(row) + 0.5, _col(col) + 0.5
    return (
        F.lit(float(affine.c)) + j * float(affine.a) + i * float(affine.b),
        F.lit(float(affine.f)) + j * float(affine.d) + i * float(affine.e),
    )


def cell_area_km2(row: Column | str, col: Column | str, affine: Affine, crs: str = "EPSG:3031") -> Column:
    """True ground area of a cell, corrected by the areal scale at its centre."""
    if crs != "EPSG:3031":
        raise ValueError("cell areas need the projected system EPSG:3031")
    nominal = abs(affine.a * affine.e - affine.b * affine.d) / 1e6
    return F.lit(nominal) / areal_scale(*cell_xy(row, col, affine))


def grid_for_bbox(df: DataFrame, keys: list[str], resolution: float, densify: int = 41) -> DataFrame:
    """Smallest whole-resolution polar grid around lon/lat boxes ``west, south, east, north``.

    Each box edge carries ``densify`` extra points, because edges bend on the map.
    """
    steps = densify + 1
    s = F.col("step") / float(steps)
    lon_at = F.col("west") + (F.col("east") - F.col("west")) * s
    lat_at = F.col("south") + (F.col("north") - F.col("south")) * s
    point = lambda lon, lat: F.struct(lon.alias("lon"), lat.alias("lat"))
    edge = df.select(*keys, "west", "south", "east", "north", F.explode(F.sequence(F.lit(0), F.lit(steps))).alias("step"))
    points = edge.select(
        *keys,
        F.explode(
            F.array(
                point(lon_at, F.col("south")),
                point(lon_at, F.col("north")),
                point(F.col("west"), lat_at),
                point(F.col("east"), lat_at),
            )
        ).alias("p"),
    )
    x, y = polar_xy("p.lon", "p.lat")
    bounds = (
        points.select(*keys, x.alias("x"), y.alias("y"))
        .groupBy(*keys)
        .agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    )
    r = float(resolution)
    left, top = F.floor(F.col("x0") / r) * r, F.ceil(F.col("y1") / r) * r
    return bounds.select(
        *keys,
        left.alias("left"),
        top.alias("top"),
        F.ceil((F.col("x1") - left) / r).alias("width"),
        F.ceil((top - F.col("y0")) / r).alias("height"),
    )


def grid_for_lonlat(df: DataFrame, dx: Column | str | float, dy: Column | str | float) -> DataFrame:
    """Angular grid over ``west, south, east, north``: round counts up, then shrink spacing to fit exactly."""
    span_x, span_y = F.col("east") - F.col("west"), F.col("north") - F.col("south")
    usable = (
        (F.col("west") > -180)
        & (F.col("west") < F.col("east"))
        & (F.col("east") < 180)
        & (F.col("south") > -90)
        & (F.col("south") < F.col("north"))
        & (F.col("north") < 90)
        & (_col(dx) > 0)
        & (_col(dy) > 0)
    )
    return (
        df.withColumn("usable", F.coalesce(usable, F.lit(False)))
        .withColumn("width", F.when(F.col("usable"), F.ceil(span_x / _col(dx))))
        .withColumn("height", F.when(F.col("usable"), F.ceil(span_y / _col(dy))))
        .withColumn("step_x", span_x / F.col("width"))
        .withColumn("step_y", span_y / F.col("height"))
    )
