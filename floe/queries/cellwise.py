"""Cell-local maps, projection and identities."""

from pyspark.sql import functions as F

from floe.functions import encode, geo
from floe.functions.identity import fingerprint, pair_id
from floe.operators.checks import validate_runs
from floe.operators.products import limitations, observation_age, summary_text
from floe.queries.fixtures import CLASS_AFFINE, Tables
from floe.queries.registry import query, r4

# Projection in SQL, from the same published formulas.
_E = geo.ECC


def polar_sql(lon: str, lat: str) -> tuple[str, str]:
    phi = f"radians(-({lat}))"
    t = f"(tan(pi() / 4 - {phi} / 2) / pow((1 - {_E!r} * sin({phi})) / (1 + {_E!r} * sin({phi})), {_E / 2!r}))"
    return f"({geo.RHO_PER_T!r} * {t} * sin(radians({lon})))", f"({geo.RHO_PER_T!r} * {t} * cos(radians({lon})))"


def latitude_sql(x: str, y: str) -> str:
    chi = f"(pi() / 2 - 2 * atan(sqrt(({x}) * ({x}) + ({y}) * ({y})) / {geo.RHO_PER_T!r}))"
    return f"({chi}" + "".join(f" + {c!r} * sin({2 * k} * {chi})" for k, c in enumerate(geo.SERIES, 1)) + ")"


def area_sql(row: str, col: str) -> str:
    """km2 of a cell of the class grid."""
    a = CLASS_AFFINE
    x, y = f"({a.c!r} + ({col} + 0.5) * {a.a!r})", f"({a.f!r} + ({row} + 0.5) * {a.e!r})"
    phi = latitude_sql(x, y)
    k = f"(sqrt({x} * {x} + {y} * {y}) / ({geo.A_WGS84!r} * cos({phi}) / sqrt(1 - {geo.E2!r} * sin({phi}) * sin({phi}))))"
    return f"({abs(a.a * a.e) / 1e6!r} / ({k} * {k}))"


def with_area(cells):
    return cells.withColumn("area_km2", geo.cell_area_km2("row", "col", CLASS_AFFINE))


@query("p1_power_to_db", "SELECT row, col, round(CASE WHEN a > 0 THEN 10 * log10(a / 1000.0) END, 6) AS db FROM fx_grid")
def p1(t: Tables):
    return t.fx_grid.select("row", "col", r4(encode.to_db(F.col("a") / 1000.0), 6).alias("db"))


@query("p2_apply_mask", "SELECT row, col, CASE WHEN (row + col) % 3 <> 0 THEN a END AS a FROM fx_grid")
def p2(t: Tables):
    return t.fx_grid.select("row", "col", encode.apply_mask(F.col("a"), (F.col("row") + F.col("col")) % 3 == 0).alias("a"))


def texture_like(t: Tables):
    """Three texture-sized bands with gaps and out-of-range values, and an exclusion flag."""
    band = lambda c, shift: (F.col(c) + shift) / 400.0
    return t.fx_grid.select(
        "row", "col", band("a", 0).alias("t1"), band("b", 90).alias("t2"), band("a", -150).alias("t3"), ((F.col("row") * 3 + F.col("col")) % 11 == 0).alias("excluded")
    )


_TEXTURE = "SELECT row, col, a / 400.0 AS t1, (b + 90) / 400.0 AS t2, (a - 150) / 400.0 AS t3, (row * 3 + col) % 11 = 0 AS excluded FROM fx_grid"
_RGB = (
    "SELECT row, col, excluded, t1 IS NOT NULL AND t2 IS NOT NULL AND t3 IS NOT NULL AS valid, "
    + ", ".join(
        f"CASE WHEN t1 IS NOT NULL AND t2 IS NOT NULL AND t3 IS NOT NULL THEN CAST(round_even(least(greatest((t{k} + 0.5) / 1.5, 0), 1) * 255, 0) AS INTEGER) ELSE 0 END AS {c}"
        for k, c in enumerate("rgb", 1)
    )
    + f" FROM ({_TEXTURE})"
)


@query("p3_encode_rgb", f"SELECT row, col, valid, r, g, b FROM ({_RGB})")
def p3(t: Tables):
    return encode.encode_rgb(texture_like(t)).select("row", "col", "valid", "r", "g", "b")


@query("p4_validity_code", f"SELECT row, col, CASE WHEN excluded THEN 2 WHEN valid THEN 1 ELSE 0 END AS validity FROM ({_RGB})")
def p4(t: Tables):
    cells = encode.encode_rgb(texture_like(t))
    return cells.select("row", "col", encode.validity_code(F.col("valid"), F.col("excluded")).alias("validity"))


@query(
    "p5_final_class",
    """SELECT row, col, CASE WHEN (row + col) % 17 = 0 THEN 1 WHEN a IS NULL OR label = 0 THEN 255 WHEN label % 4 = 1 THEN 255
 ELSE label % 4 END AS cls FROM fx_grid""",
)
def p5(t: Tables):
    label = F.col("label")
    predicted = F.when(label % 4 != 1, label % 4)
    code = encode.final_class(predicted, label, F.col("a").isNotNull(), (F.col("row") + F.col("col")) % 17 == 0)
    return t.fx_grid.select("row", "col", code.alias("cls"))


@query(
    "p6_code_check",
    "SELECT cls, count(*) AS cells FROM (SELECT CASE WHEN row % 50 = 7 THEN 4 + col % 3 ELSE curr END AS cls FROM fx_cls) WHERE cls NOT IN (0, 1, 2, 3, 255) GROUP BY cls",
)
def p6(t: Tables):
    spoiled = F.when(F.col("row") % 50 == 7, 4 + F.col("col") % 3).otherwise(F.col("curr"))
    return encode.unknown_codes(t.fx_cls.select(spoiled.alias("cls")))


@query(
    "p7_composite_rgba",
    f"""SELECT row, col, CASE WHEN excluded THEN 88 ELSE r END AS r, CASE WHEN excluded THEN 94 ELSE g END AS g,
 CASE WHEN excluded THEN 99 ELSE b END AS b, CASE WHEN valid OR excluded THEN 255 ELSE 0 END AS alpha FROM ({_RGB})""",
)
def p7(t: Tables):
    return encode.composite_rgba(encode.encode_rgb(texture_like(t))).select("row", "col", "r", "g", "b", "alpha")


@query(
    "p8_class_rgba",
    """SELECT row, col, coalesce(r, 235) AS r, coalesce(g, 235) AS g, coalesce(b, 235) AS b, CASE WHEN curr = 255 THEN 0 ELSE 255 END AS alpha
FROM fx_cls LEFT JOIN (VALUES (0, 15, 35, 48), (1, 88, 94, 99), (2, 68, 218, 100), (3, 240, 170, 40)) p(code, r, g, b) ON code = curr""",
)
def p8(t: Tables):
    return encode.class_rgba(encode.assert_codes(t.fx_cls, "curr"), "curr").select("row", "col", "r", "g", "b", "alpha")


@query("p9_label_template", "SELECT row, col, 255 AS label FROM fx_cls")
def p9(t: Tables):
    return encode.label_template(t.fx_cls, ["row", "col"])


@query(
    "p10_usable_labels",
    """SELECT row, col, CASE WHEN validity <> 1 OR (row + col) % 13 = 0 THEN 255 WHEN cls IN (0, 2, 3) THEN cls ELSE 255 END AS label FROM fx_val""",
)
def p10(t: Tables):
    label = F.when(F.col("cls").isin(0, 2, 3), F.col("cls"))
    return t.fx_val.select("row", "col", encode.usable_label(label, F.col("validity"), (F.col("row") + F.col("col")) % 13).alias("label"))


@query("p11_ice_predicates", "SELECT row, col, curr IN (2, 3) AS ice, curr IN (0, 2, 3) AS observed FROM fx_cls")
def p11(t: Tables):
    return t.fx_cls.select(
        "row", "col", encode.is_fast_ice(F.col("curr")).alias("ice"), encode.is_observed_ocean(F.col("curr")).alias("observed")
    )


_X, _Y = polar_sql("west", "south")


@query("p12_polar_xy", f"SELECT file_id, round({_X}, 4) AS x, round({_Y}, 4) AS y FROM fx_cat")
def p12(t: Tables):
    x, y = geo.polar_xy("west", "south")
    return t.fx_cat.select("file_id", r4(x).alias("x"), r4(y).alias("y"))


@query(
    "p13_lonlat",
    f"""SELECT row, col, round(degrees(atan2(x, y)), 8) AS lon, round(-degrees({latitude_sql('x', 'y')}), 8) AS lat
FROM (SELECT row, col, 2289600.0 + (col + 0.5) * 40 AS x, 503520.0 - (row + 0.5) * 40 AS y FROM fx_cls)""",
)
def p13(t: Tables):
    lon, lat = geo.lonlat(*geo.cell_xy("row", "col", CLASS_AFFINE))
    return t.fx_cls.select("row", "col", r4(lon, 8).alias("lon"), r4(lat, 8).alias("lat"))


@query(
    "p14_cell_centres",
    "SELECT row, col, CAST(100 + (col + 0.5) * 30 + (row + 0.5) * 2 AS DOUBLE) AS x, CAST(900 + (col + 0.5) * 1.5 - (row + 0.5) * 40 AS DOUBLE) AS y FROM fx_cls",
)
def p14(t: Tables):
    from floe.schema import Affine

    x, y = geo.cell_xy("row", "col", Affine(30, 2, 100, 1.5, -40, 900))
    return t.fx_cls.select("row", "col", x.alias("x"), y.alias("y"))


@query("p15_cell_area", f"SELECT row, col, round({area_sql('row', 'col')}, 10) AS area_km2 FROM fx_cls")
def p15(t: Tables):
    return with_area(t.fx_cls).select("row", "col", r4("area_km2", 10).alias("area_km2"))


_EX, _EY = polar_sql("lon", "lat")


@query(
    "p16_grid_for_bbox",
    f"""
WITH s AS (SELECT box_id, k / 42.0 AS s, west, east, south, north FROM fx_box, range(43) r(k)),
p AS (SELECT box_id, unnest([west + (east - west) * s, west + (east - west) * s, west, east]) AS lon,
  unnest([south, north, south + (north - south) * s, south + (north - south) * s]) AS lat FROM s),
b AS (SELECT box_id, min({_EX}) AS x0, max({_EX}) AS x1, min({_EY}) AS y0, max({_EY}) AS y1 FROM p GROUP BY box_id),
g AS (SELECT *, floor(x0 / 40) * 40 AS l, ceil(y1 / 40) * 40 AS t FROM b)
SELECT box_id, l AS "left", t AS top, CAST(ceil((x1 - l) / 40) AS BIGINT) AS width, CAST(ceil((t - y0) / 40) AS BIGINT) AS height FROM g""",
)
def p16(t: Tables):
    return geo.grid_for_bbox(t.fx_box, ["box_id"], 40)


@query(
    "p17_grid_for_lonlat",
    """SELECT box_id, CAST(ceil((east - west) / 0.3) AS BIGINT) AS width, CAST(ceil((north - south) / 0.7) AS BIGINT) AS height,
 round((east - west) / ceil((east - west) / 0.3), 8) AS step_x, round((north - south) / ceil((north - south) / 0.7), 8) AS step_y FROM fx_box""",
)
def p17(t: Tables):
    grid = geo.grid_for_lonlat(t.fx_box, 0.3, 0.7)
    return grid.select("box_id", "width", "height", r4("step_x", 8).alias("step_x"), r4("step_y", 8).alias("step_y"))


@query(
    "p18_pair_id",
    """SELECT product_id, concat(strftime(first_time, '%Y%m%dT%H%M%S'), '_', strftime(second_time, '%Y%m%dT%H%M%S'), '_',
 substr(sha256(concat(CAST(product_id AS VARCHAR), '|', CAST(product_id + 1 AS VARCHAR))), 1, 8)) AS pair_id FROM fx_prod""",
)
def p18(t: Tables):
    name = pair_id(F.col("first_time"), F.col("second_time"), F.col("product_id"), F.col("product_id") + 1)
    return t.fx_prod.select("product_id", name.alias("pair_id"))


@query(
    "p19_fingerprint",
    """SELECT scene_no, sha256(concat(image_hash, region, 'code', '{"classifier": "', region, '", "coastline": "', scene_group, '"}', '{"window": 11}')) AS fingerprint FROM fx_doc""",
)
def p19(t: Tables):
    resources = F.create_map(F.lit("coastline"), F.col("scene_group"), F.lit("classifier"), F.col("region"))
    print_ = fingerprint(F.col("image_hash"), F.col("region"), F.lit("code"), resources, F.lit('{"window": 11}'))
    return t.fx_doc.select("scene_no", print_.alias("fingerprint"))


@query(
    "p20_validate_runs",
    """
SELECT run_id, concat_ws(',',
  CASE WHEN NOT (west >= -180 AND west < east AND east <= 180 AND south >= -90 AND south < north AND north <= 90) THEN 'bbox' END,
  CASE WHEN run_id % 13 = 0 OR run_id % 29 = 0 THEN 'region name' END,
  CASE WHEN end_date < start_date THEN 'dates' END,
  CASE WHEN NOT (0 < min_days AND min_days <= max_days) THEN 'baseline' END,
  CASE WHEN NOT (0 < min_overlap AND min_overlap <= 1) THEN 'overlap' END,
  CASE WHEN polarization NOT IN ('HH', 'VV') THEN 'polarization' END,
  CASE WHEN resolution <= 0 OR tile_size < 32 THEN 'grid' END,
  CASE WHEN w1 % 2 = 0 THEN 'windows' END) AS reasons FROM fx_run""",
)
def p20(t: Tables):
    runs = validate_runs(t.fx_run.withColumn("windows", F.array("w1", "w2", "w3")))
    return runs.select("run_id", F.array_join("reasons", ",").alias("reasons"))


@query(
    "p21_summary_text",
    """
SELECT product_id, CASE WHEN synthetic THEN 'SYNTHETIC TEST DATA. This bulletin tests the software and layout; it describes no observed Davis conditions.'
  ELSE concat('Observations ', strftime(first_time, '%Y-%m-%d'), ' to ', strftime(second_time, '%Y-%m-%d'), ' (12.0-day baseline).',
    CASE WHEN status = 'segmentation_only' THEN ' Texture segmentation is available; fast-ice extent, change and persistence cannot yet be reported because no trained classification was applied.'
    ELSE concat(' Candidate fast-ice coverage: ', printf('%.1f', round(ice_km2)), ' km² within the observed ocean domain. This is an unvalidated research classification.') END) END
  || CASE WHEN date_diff('day', second_time, TIMESTAMP '1999-01-01') > 14 THEN concat(' Latest observation is ', CAST(date_diff('day', second_time, TIMESTAMP '1999-01-01') AS VARCHAR), ' days old; no current-conditions assessment is available.') ELSE '' END AS summary
FROM fx_prod""",
)
def p21(t: Tables):
    days = (F.unix_timestamp(F.col("second_time").cast("timestamp")) - F.unix_timestamp(F.col("first_time").cast("timestamp"))) / 86400.0
    age = observation_age(F.lit("1999-01-01").cast("date"), F.col("second_time"))
    text = summary_text(F.col("synthetic"), F.col("status"), F.col("first_time"), F.col("second_time"), days, F.round("ice_km2"), age)
    return t.fx_prod.select("product_id", text.alias("summary"))


@query(
    "p22_limitations",
    """
SELECT product_id, concat_ws(' / ', 'Not validated', CASE WHEN product_id % 2 = 0 THEN 'Candidate model transfer: source preprocessing/station differs or is incompletely documented.' END,
  CASE WHEN product_id % 5 = 1 THEN 'Melting-fast-ice class 3 has only one training segment; its performance is not established.' END) AS limitations FROM fx_prod""",
)
def p22(t: Tables):
    p = F.col("product_id")
    items = limitations(F.array(F.lit("Not validated"), F.lit("Not validated")), p % 2 == 0, p % 5)
    return t.fx_prod.select("product_id", F.array_join(items, " / ").alias("limitations"))


@query(
    "w5_observation_age",
    """SELECT product_id, date_diff('day', CAST(second_time AS DATE), DATE '1998-06-01') AS age, date_diff('day', CAST(second_time AS DATE), DATE '1998-06-01') > 14 AS stale
FROM fx_prod WHERE second_time <= TIMESTAMP '1998-06-01 23:59:59'""",
)
def w5(t: Tables):
    issue = F.lit("1998-06-01").cast("date")
    age = observation_age(issue, F.col("second_time"))
    seen = t.fx_prod.filter(F.col("second_time") <= F.to_timestamp(F.lit("1998-06-01 23:59:59")))
    return seen.select("product_id", age.cast("bigint").alias("age"), (age > 14).alias("stale"))
