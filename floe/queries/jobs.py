"""Whole user jobs on the given tables."""

from pyspark.sql import functions as F

from floe.operators import classify, metrics
from floe.operators.masks import polygon_edges
from floe.operators.terrain import merge_report
from floe.plans import acquisition, product, reports, surfaces, training, validation
from floe.queries.aggregates import _LABELLED, labelled_cells
from floe.queries.cellwise import area_sql, with_area
from floe.queries.fixtures import CLASS_AFFINE, DAVIS, SCENE_OUTLINES, UNIT_AFFINE, Tables, scene_of
from floe.queries.joins import _EDGE, _POLAR, _TARGET, RULES, bilinear_sql, outline_edges, regrid_targets
from floe.queries.learning import _NEAREST, _TRAIN, training_rows
from floe.queries.registry import day, query, r4
from floe.queries.sources import catalogue_lines, orbit_names, outlines
from floe.queries.timeline import WEEKS, described
from floe.schema import Affine, Grid
from floe.sources.catalog import parse_features
from floe.sources.orbits import parse_orbit_documents

_FOUND = """(SELECT * FROM fx_cat WHERE start_time >= TIMESTAMP '2024-01-02' AND start_time <= TIMESTAMP '2024-01-25 23:59:59'
  AND beam_mode IN ('click', 'view', 'error') AND file_id % 4 <> 0 AND east >= 75.5 AND west <= 80.5 AND north >= -69.2 AND south <= -67.3)"""


@query("b1_discover_pairs", _POLAR.replace("FROM fx_cat a JOIN fx_cat b", f"FROM {_FOUND} a JOIN {_FOUND} b"))
def b1(t: Tables):
    found = acquisition.discover_pairs(
        parse_features(catalogue_lines(t)), DAVIS, "2024-01-02", "2024-01-25", ["click", "view", "error"], ["GRD_HD"], RULES
    )
    return found.select("pair_id", r4("common_aoi_fraction").alias("common_aoi_fraction"))


@query("b2_pair_product")
def b2(t: Tables):
    """Raw pair cells to classes and extent; superpixels have no SQL form."""
    height = t.embeddings.count()
    grid = Grid(CLASS_AFFINE, height, 64)
    edges = polygon_edges(outlines(t).filter("surface <> 'ocean'"), ["poly_id"]).withColumn("scene_id", scene_of("poly_id", SCENE_OUTLINES))
    shift = lambda v, c, a: F.lit(c) + F.col(v) * a
    on_map = edges.withColumns({"x1": shift("x1", CLASS_AFFINE.c, 40), "x2": shift("x2", CLASS_AFFINE.c, 40), "y1": shift("y1", CLASS_AFFINE.f, -40), "y2": shift("y2", CLASS_AFFINE.f, -40)})
    settings = product.Settings(widths=(5, 9, 13), tile=64, downsample=2, n_segments=120, rounds=3)
    made = product.pair_product(t.raster(), product.grid_edges(on_map, t.grid()), grid, classify.centroids(training_rows(t)), settings)
    return product.product_metrics(made)


_SITE = """SELECT s.scene_id, s.segment_id, s.r, s.g, s.b, a.label, d.lang AS fold FROM fx_annseg s JOIN fx_ann a USING (scene_id, segment_id)
 JOIN documents d ON d.doc_id = s.scene_id WHERE s.segment_id > 0 AND a.label IN (0, 2, 3)"""


@query(
    "b3_train_and_assess",
    f"""
WITH r AS MATERIALIZED ({_SITE}),
c AS (SELECT f.fold, r.label, avg(r.r) AS r, avg(r.g) AS g, avg(r.b) AS b FROM (SELECT DISTINCT fold FROM r) f JOIN r ON r.fold <> f.fold GROUP BY f.fold, r.label),
p AS (SELECT x.fold, x.label, m.label AS pred, row_number() OVER (PARTITION BY x.scene_id, x.segment_id ORDER BY {_NEAREST}, m.label) AS k FROM r x JOIN c m ON m.fold = x.fold),
a AS (SELECT fold, avg(recall) AS acc FROM (SELECT fold, label, count(*) FILTER (label = pred) / count(*) AS recall FROM p WHERE k = 1 GROUP BY ALL) GROUP BY fold),
n AS (SELECT fold, count(*) AS test_rows FROM r GROUP BY fold)
SELECT a.fold AS site, (SELECT count(*) FROM r) - n.test_rows AS training_rows, n.test_rows, 'assessed' AS status, round(a.acc, 6) AS balanced_accuracy FROM a JOIN n ON n.fold = a.fold""",
)
def b3(t: Tables):
    """Annotated scenes to a training table, held out site by site."""
    d = F.col("doc_id")
    scenes = t.documents.select(
        d.alias("scene_id"), F.lower("lang").alias("region"),
        F.array(*[day(F.date_add(F.lit("2021-01-01").cast("date"), (d * 40 + k).cast("int"))) for k in (0, 12)]).alias("dates"),
        d.cast("string").alias("image_hash"),
    )
    rows = training.train_from_annotations(scenes, t.fx_annseg, t.fx_ann, ["image_hash"])
    summary = training.fold_summary(rows.withColumnRenamed("region", "site"), "site")
    return summary.select("site", "training_rows", "test_rows", "status", r4("balanced_accuracy", 6).alias("balanced_accuracy"))


@query(
    "b4_train_from_labels",
    f"""
WITH l AS (SELECT scene_id, segment_id, CASE WHEN r % 9 = 0 THEN 255 ELSE label END AS label FROM ({_LABELLED.replace("SELECT scene_id", "SELECT r, scene_id")})),
v AS (SELECT scene_id, segment_id, label, count(*) AS n FROM l WHERE segment_id > 0 AND label IN (0, 2, 3) GROUP BY ALL),
k AS (SELECT *, sum(n) OVER (PARTITION BY scene_id, segment_id) AS total, row_number() OVER (PARTITION BY scene_id, segment_id ORDER BY n DESC, label) AS k FROM v),
m AS (SELECT scene_id, segment_id, avg(r) AS r, avg(g) AS g, avg(b) AS b FROM fx_seg WHERE segment_id > 0 GROUP BY ALL)
SELECT m.scene_id, m.segment_id, round(r, 4) AS r, round(g, 4) AS g, round(b, 4) AS b, label FROM k JOIN m USING (scene_id, segment_id) WHERE k = 1 AND n / total >= 0.9""",
)
def b4(t: Tables):
    cells = labelled_cells(t).withColumn("validity", F.when(F.col("r") % 9 == 0, 0).otherwise(1))
    rows = training.train_from_labels(cells)
    return rows.select("scene_id", "segment_id", *[r4(c).alias(c) for c in "rgb"], "label")


@query(
    "b5_reclassify_product",
    f"""
WITH s AS (SELECT scene_id, segment_id, avg(r) AS r, avg(g) AS g, avg(b) AS b FROM fx_seg WHERE segment_id > 0 GROUP BY ALL),
m AS (SELECT label, avg(r) AS r, avg(g) AS g, avg(b) AS b FROM ({_TRAIN}) GROUP BY label),
p AS (SELECT scene_id, segment_id, predicted FROM (SELECT x.scene_id, x.segment_id, m.label AS predicted,
  row_number() OVER (PARTITION BY x.scene_id, x.segment_id ORDER BY {_NEAREST}, m.label) AS k FROM s x, m) WHERE k = 1),
c AS (SELECT c.scene_id, {area_sql('c.row', 'c.col')} AS area, CASE WHEN (c.row + c.col) % 17 = 0 THEN 1 WHEN c.r % 9 = 0 OR c.segment_id = 0 THEN 255 ELSE coalesce(p.predicted, 255) END AS cls
  FROM fx_seg c LEFT JOIN p USING (scene_id, segment_id))
SELECT scene_id, round(sum(CASE WHEN cls IN (2, 3) THEN area ELSE 0 END), 4) AS ice_km2, round(sum(CASE WHEN cls IN (0, 2, 3) THEN area ELSE 0 END), 4) AS observed_km2,
  count(*) FILTER (cls = 255) AS unknown_cells FROM c GROUP BY scene_id""",
)
def b5(t: Tables):
    cells = t.fx_seg.withColumns({"valid": F.col("r") % 9 != 0, "excluded": (F.col("row") + F.col("col")) % 17 == 0})
    made = product.reclassify(cells, classify.centroids(training_rows(t)), CLASS_AFFINE)
    found = metrics.extent_metrics(made, ["scene_id"])
    return found.select("scene_id", r4("ice_km2").alias("ice_km2"), r4("observed_km2").alias("observed_km2"), "unknown_cells")


def _inside_sql(surfaces: str) -> str:
    return f"""SELECT DISTINCT row, col FROM (SELECT c.row, c.col, e.poly_id, count(*) AS n FROM fx_val c JOIN (SELECT * FROM ({_EDGE}) WHERE surface IN ({surfaces})) e
    ON (e.y1 > c.row + 0.5) <> (e.y2 > c.row + 0.5) AND c.col + 0.5 < e.x1 + (c.row + 0.5 - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1) GROUP BY ALL) WHERE n % 2 = 1"""


@query(
    "b6_validate_outline",
    f"""
WITH c AS (SELECT v.*, d.row IS NOT NULL AS dom, r.row IS NOT NULL AS ref, {area_sql('v.row', 'v.col')} AS area FROM fx_val v
  LEFT JOIN ({_inside_sql("'land', 'rumple'")}) d ON d.row = v.row AND d.col = v.col LEFT JOIN ({_inside_sql("'ice shelf', 'rumple'")}) r ON r.row = v.row AND r.col = v.col),
o AS (SELECT *, dom AND validity <> 2 AND cls <> 1 AS ocean, dom AND validity = 1 AND cls IN (0, 2, 3) AS used FROM c),
s AS (SELECT sum(CASE WHEN used AND cls <> 0 AND ref THEN area ELSE 0 END) AS tp, sum(CASE WHEN used AND cls <> 0 AND NOT ref THEN area ELSE 0 END) AS fp,
  sum(CASE WHEN used AND cls = 0 AND ref THEN area ELSE 0 END) AS fn, sum(CASE WHEN used AND cls = 0 AND NOT ref THEN area ELSE 0 END) AS tn,
  sum(CASE WHEN ocean THEN area ELSE 0 END) AS oc, sum(CASE WHEN ocean AND NOT used THEN area ELSE 0 END) AS un FROM o)
SELECT round(tp, 4) AS tp_km2, round(fp, 4) AS fp_km2, round(fn, 4) AS fn_km2, round(tn, 4) AS tn_km2, round(oc, 4) AS ocean_km2, round(un, 4) AS unassessed_km2,
  round(tp / nullif(tp + fp, 0), 6) AS "precision", round(tp / nullif(tp + fn, 0), 6) AS recall, round(tp / nullif(tp + fp + fn, 0), 6) AS iou FROM s""",
)
def b6(t: Tables):
    cells = t.fx_val.select(scene_of("row"), "row", "col", "cls", "validity")
    shape = cells.groupBy("scene_id").agg((F.max("row") + 1).alias("height"), (F.max("col") + 1).alias("width"))
    edges = lambda *names: product.grid_edges(polygon_edges(outlines(t).filter(F.col("surface").isin(*names)), ["poly_id"]).withColumn("scene_id", scene_of("poly_id", SCENE_OUTLINES)), shape)
    found = validation.validate_outline(cells, edges("land", "rumple"), edges("ice shelf", "rumple"), UNIT_AFFINE, CLASS_AFFINE)
    areas = [r4(c).alias(c) for c in ("tp_km2", "fp_km2", "fn_km2", "tn_km2", "ocean_km2", "unassessed_km2")]
    return found.select(*areas, *[r4(c, 6).alias(c) for c in ("precision", "recall", "iou")])


def published(t: Tables):
    return described(t).withColumn("baseline_days", F.lit(12.0)).withColumn("ice_km2", F.round("ice_km2"))


def product_cells(t: Tables):
    return with_area(t.fx_prodcell)


_REPORT = """
WITH s AS (SELECT region, synthetic, status, second_time, max(product_id) AS top FROM fx_prod GROUP BY ALL),
l AS (SELECT *, lag(top) OVER (PARTITION BY region, synthetic, status ORDER BY second_time) AS prev_id FROM s),
k AS (SELECT p.*, q.product_id AS prev_id, q.second_time AS prev_time, p.status = 'candidate_classification' AND q.product_id IS NOT NULL AND p.processing = q.processing AND p.segmentation = q.segmentation
    AND p.classifier IS NOT DISTINCT FROM q.classifier AND p.mask_hash = q.mask_hash AND p.implementation_hash = q.implementation_hash AND p.grid_height = q.grid_height AS comparable
  FROM fx_prod p JOIN l USING (region, synthetic, status, second_time) LEFT JOIN fx_prod q ON q.product_id = l.prev_id),
i AS (SELECT * FROM (SELECT w.issue_date, p.*, row_number() OVER (PARTITION BY w.issue_date, p.region ORDER BY second_time DESC, first_time DESC, created_time DESC, product_id DESC) AS n
  FROM ({weeks}) w JOIN k p ON p.second_time <= w.issue_date + INTERVAL 86399 SECOND) WHERE n = 1),
m AS (SELECT i.issue_date, i.region, sum(CASE WHEN a.cls IN (0, 2, 3) AND b.cls IN (0, 2, 3) THEN {area} ELSE 0 END) AS common,
    sum(CASE WHEN b.cls = 0 AND a.cls IN (2, 3) THEN {area} ELSE 0 END) AS gain, sum(CASE WHEN b.cls IN (2, 3) AND a.cls = 0 THEN {area} ELSE 0 END) AS loss
  FROM i JOIN fx_prodcell a ON a.product_id = i.product_id JOIN fx_prodcell b ON b.product_id = i.prev_id AND b.row = a.row AND b.col = a.col WHERE i.comparable GROUP BY ALL),
c AS (SELECT i.issue_date, i.region, coalesce(m.common, 0) AS common, coalesce(m.gain, 0) AS gain, coalesce(m.loss, 0) AS loss
  FROM i LEFT JOIN m ON m.issue_date = i.issue_date AND m.region = i.region WHERE i.comparable)
SELECT i.region, strftime(i.issue_date, '%Y-%m-%d') AS issue_date, i.product_id, CASE WHEN i.comparable THEN i.prev_id END AS compared_with,
  date_diff('day', CAST(i.second_time AS DATE), i.issue_date) AS age_days, round(c.gain, 4) AS gain_km2, round(c.loss, 4) AS loss_km2, round(c.common, 4) AS common_km2,
  CASE WHEN i.synthetic THEN 'SYNTHETIC TEST DATA. This bulletin tests the software and layout; it describes no observed Davis conditions.'
    ELSE concat('Observations ', strftime(i.first_time, '%Y-%m-%d'), ' to ', strftime(i.second_time, '%Y-%m-%d'), ' (12.0-day baseline).',
      CASE WHEN i.status = 'segmentation_only' THEN ' Texture segmentation is available; fast-ice extent, change and persistence cannot yet be reported because no trained classification was applied.'
      ELSE concat(' Candidate fast-ice coverage: ', printf('%.1f', round(i.ice_km2)), ' km² within the observed ocean domain. This is an unvalidated research classification.') END) END
  || CASE WHEN date_diff('day', CAST(i.second_time AS DATE), i.issue_date) > 14 THEN concat(' Latest observation is ', CAST(date_diff('day', CAST(i.second_time AS DATE), i.issue_date) AS VARCHAR), ' days old; no current-conditions assessment is available.') ELSE '' END
  || CASE WHEN i.status = 'candidate_classification' AND i.prev_id IS NOT NULL AND c.common IS NULL THEN ' No comparable prior classification is available for change assessment.'
     WHEN i.status = 'candidate_classification' AND c.common > 0 THEN concat(' On common observed coverage: gain ', printf('%.1f', c.gain), ' km², loss ', printf('%.1f', c.loss), ' km² since ', strftime(i.prev_time, '%Y-%m-%d'), '.') ELSE '' END AS summary
FROM i LEFT JOIN c ON c.issue_date = i.issue_date AND c.region = i.region"""


def _shown(found):
    areas = [r4(c).alias(c) for c in ("gain_km2", "loss_km2", "common_km2")]
    return found.select("region", day("issue_date").alias("issue_date"), "product_id", "compared_with", F.col("age_days").cast("bigint").alias("age_days"), *areas, "summary")


@query("b7_issue_report", _REPORT.format(weeks="SELECT DATE '1998-02-20' AS issue_date", area=area_sql("a.row", "a.col")))
def b7(t: Tables):
    return _shown(reports.issue_report(published(t), product_cells(t), "1998-02-20"))


@query("b8_season_reports", _REPORT.format(weeks=WEEKS, area=area_sql("a.row", "a.col")))
def b8(t: Tables):
    return _shown(reports.season_reports(published(t), product_cells(t), 1997))


# Elevation grid: 0.8 cell spacing over the raster, as in the regridding query.
_FINE = Affine(0.8, 0.0, -0.93, 0.0, 0.8, 1.37)


# Outlines in target cell units, tested cell by cell.
_FINE_EDGE = f"SELECT poly_id, (x1 + 0.93) / 0.8 AS x1, (y1 - 1.37) / 0.8 AS y1, (x2 + 0.93) / 0.8 AS x2, (y2 - 1.37) / 0.8 AS y2 FROM ({_EDGE})"
_FINE_LAND = f"""
SELECT DISTINCT row, col FROM (SELECT c.row, c.col, e.poly_id, count(*) AS n FROM ({_TARGET}) c JOIN ({_FINE_EDGE}) e
  ON (e.y1 > c.row + 0.5) <> (e.y2 > c.row + 0.5) AND c.col + 0.5 < e.x1 + (c.row + 0.5 - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1) GROUP BY ALL) WHERE n % 2 = 1
UNION SELECT DISTINCT c.row, c.col FROM ({_TARGET}) c JOIN (SELECT *, greatest(least(y1, y2), r) AS ya, least(greatest(y1, y2), r + 1) AS yb
    FROM ({_FINE_EDGE}) JOIN range(0, 100000) b(r) ON r BETWEEN floor(least(y1, y2)) AND floor(greatest(y1, y2))) e ON e.r = c.row
  AND c.col BETWEEN floor(CASE WHEN y1 = y2 THEN least(x1, x2) ELSE least(x1 + (ya - y1) * (x2 - x1) / (y2 - y1), x1 + (yb - y1) * (x2 - x1) / (y2 - y1)) END)
    AND floor(CASE WHEN y1 = y2 THEN greatest(x1, x2) ELSE greatest(x1 + (ya - y1) * (x2 - x1) / (y2 - y1), x1 + (yb - y1) * (x2 - x1) / (y2 - y1)) END)"""


@query(
    "b9_prepare_elevation",
    f"""
WITH m AS (SELECT a.row, a.col, a.a AS terrain, b.b AS geoid, l.row IS NOT NULL AS land FROM ({bilinear_sql('a')}) a JOIN ({bilinear_sql('b')}) b USING (row, col)
  LEFT JOIN ({_FINE_LAND}) l ON l.row = a.row AND l.col = a.col)
SELECT count(*) FILTER (land) AS land_cells, count(*) FILTER (NOT land) AS ocean_cells, count(*) FILTER (land AND terrain IS NULL) AS missing_land,
  count(*) FILTER (NOT land AND geoid IS NULL) AS missing_ocean, round(avg(CASE WHEN land THEN terrain ELSE geoid END), 4) AS mean_elevation FROM m""",
)
def b9(t: Tables):
    """Cells per surface and failures after merging regridded terrain and geoid."""
    edges = outline_edges(t).withColumn("width", F.lit(84).cast("bigint"))
    heights = t.raster().withColumnsRenamed({"a": "terrain", "b": "geoid"})
    made = surfaces.prepare_elevation(regrid_targets(t), heights, edges, _FINE)
    totals = merge_report(made, ["scene_id"], [r4(F.avg("elevation")).alias("mean_elevation")])
    return totals.drop("scene_id")


@query(
    "b10_prepare_exclusions",
    """SELECT 'source' AS stage, surface, count(*) AS polygons FROM fx_outline GROUP BY surface
UNION ALL SELECT 'output', surface, count(*) FROM fx_outline WHERE surface <> 'ocean' AND x0 + size > 10 AND x0 < 40 AND y0 + 2 * size > 49.8 AND y0 < 300.2 GROUP BY surface""",
)
def b10(t: Tables):
    return surfaces.prepare_exclusions(outlines(t), (10.2, 50.0, 39.8, 300.0), 0.2)[1]


@query(
    "b11_orbit_readiness",
    """
WITH m AS (SELECT s.file_id, s.mission, o.mission || CAST(o.creation AS VARCHAR) AS name, row_number() OVER (PARTITION BY s.file_id ORDER BY o.creation DESC NULLS LAST) AS k, count(o.name) OVER (PARTITION BY s.file_id) AS candidates
  FROM fx_cat s LEFT JOIN (SELECT * FROM fx_orb WHERE day(day) % 7 <> 0) o ON o.mission = s.mission AND o.valid_from <= s.start_time - INTERVAL 60 SECOND AND s.stop_time + INTERVAL 60 SECOND <= o.valid_to)
SELECT mission, CASE WHEN name IS NULL THEN 'no_orbit' ELSE 'matched' END AS status, count(*) AS scenes, count(DISTINCT name) AS orbit_files, CAST(sum(candidates) AS BIGINT) AS candidates FROM m WHERE k = 1 GROUP BY ALL""",
)
def b11(t: Tables):
    return acquisition.orbit_readiness(t.fx_cat, orbit_names(t))


def _orbit_content(t: Tables):
    """XML of every listed orbit file: an hourly vector where events fall in the hour, and one at each end of validity.

    Some contradict their header, list vectors backwards, hold a NaN, or end six hours early.
    """
    utc = lambda c: F.date_format(c, "'UTC='yyyy-MM-dd'T'HH:mm:ss")
    day, one = F.dayofmonth("day"), F.col("issue") == 1
    hours = t.events.select(F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("t")).distinct()
    files = t.fx_orb.drop("name").join(orbit_names(t).withColumn("key", F.substring("name", 1, 40)), F.concat("mission", F.lit("_OPER_AUX_POEORB_OPOD_"), F.date_format("creation", "yyyyMMdd'T'HHmmss")) == F.col("key"))
    ends = files.select("name", F.explode(F.array(F.col("valid_from").cast("timestamp"), F.col("valid_to").cast("timestamp"))).alias("t"))
    # hours meet files by day, a file touches three of them
    touched = files.withColumn("on", F.explode(F.sequence(F.to_date("valid_from"), F.to_date("valid_to"))))
    inner = touched.join(hours, (F.to_date("t") == F.col("on")) & (F.col("t") > F.col("valid_from")) & (F.col("t") < F.col("valid_to"))).select("name", "t")
    early = F.when((F.col("mission") == "S1B") & (day % 9 == 0), F.col("valid_to") - F.expr("INTERVAL 6 HOURS")).otherwise(F.col("valid_to"))
    rows = files.join(ends.unionByName(inner), "name").filter(F.col("t") <= early)
    x = F.when((F.col("mission") == "S1B") & (day % 5 == 0), "NaN").otherwise("1.5")
    rest = "".join(f"<{c}>2</{c}>" for c in ("Y", "Z", "VX", "VY", "VZ"))
    vector = F.concat(F.lit("<OSV><UTC>"), utc("t"), F.lit("</UTC><X>"), x, F.lit(f"</X>{rest}</OSV>"))
    listed = rows.groupBy("name", "mission", "issue", "day", "valid_from", "valid_to").agg(F.array_sort(F.collect_list(F.struct("t", vector.alias("v")))).alias("m"))
    body = F.array_join(F.when(one & (day % 4 == 0), F.reverse("m.v")).otherwise(F.col("m.v")), "")
    craft = F.when(one & (day % 6 == 0), "Sentinel-1C").otherwise(F.concat(F.lit("Sentinel-1"), F.substring("mission", 3, 1)))
    head = F.concat(
        F.lit("<Earth_Explorer_File><Earth_Explorer_Header><Fixed_Header><File_Type>AUX_POEORB</File_Type><Mission>"), craft, F.lit("</Mission><Validity_Period><Validity_Start>"),
        utc("valid_from"), F.lit("</Validity_Start><Validity_Stop>"), utc("valid_to"), F.lit("</Validity_Stop></Validity_Period></Fixed_Header></Earth_Explorer_Header><Data_Block><List_of_OSVs>"),
    )
    return listed.select(F.col("name").alias("file"), F.concat(head, body, F.lit("</List_of_OSVs></Data_Block></Earth_Explorer_File>")).alias("xml"))


@query(
    "b11_sound_orbit_readiness",
    """
WITH f AS (SELECT *, concat(mission, CAST(creation AS VARCHAR)) AS name, day(day) AS d FROM fx_orb WHERE day(day) % 7 <> 0),
v AS (SELECT f.name, f.issue, f.d, f.mission, f.valid_to, u.t FROM f, (SELECT DISTINCT date_trunc('hour', ts) AS t FROM events) u WHERE u.t > f.valid_from AND u.t < f.valid_to
  UNION ALL SELECT name, issue, d, mission, valid_to, valid_from FROM f UNION ALL SELECT name, issue, d, mission, valid_to, valid_to FROM f),
k AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY CASE WHEN issue = 1 AND d % 4 = 0 THEN -epoch(t) ELSE epoch(t) END) AS pos
  FROM v WHERE NOT (mission = 'S1B' AND d % 9 = 0) OR t <= valid_to - INTERVAL 6 HOUR),
l AS (SELECT *, lag(t) OVER (PARTITION BY name ORDER BY pos) AS before FROM k),
sound AS (SELECT name, arg_min(t, pos) AS a, arg_max(t, pos) AS z FROM l GROUP BY name
  HAVING count(*) >= 2 AND bool_and(before IS NULL OR before < t) AND NOT bool_or(mission = 'S1B' AND d % 5 = 0) AND NOT bool_or(issue = 1 AND d % 6 = 0)),
m AS (SELECT s.file_id, s.mission, count(f.name) AS candidates, arg_max(f.name, f.creation) FILTER (WHERE x.a <= s.start_time - INTERVAL 60 SECOND AND s.stop_time + INTERVAL 60 SECOND <= x.z) AS best
  FROM fx_cat s LEFT JOIN f ON f.mission = s.mission AND f.valid_from <= s.start_time - INTERVAL 60 SECOND AND s.stop_time + INTERVAL 60 SECOND <= f.valid_to
  LEFT JOIN sound x ON x.name = f.name GROUP BY s.file_id, s.mission)
SELECT mission, CASE WHEN candidates = 0 THEN 'no_orbit' WHEN best IS NULL THEN 'unsound_orbit' ELSE 'matched' END AS status, count(*) AS scenes, count(DISTINCT best) AS orbit_files, CAST(sum(candidates) AS BIGINT) AS candidates
FROM m GROUP BY ALL""",
)
def b11_sound(t: Tables):
    """Readiness by what orbit files hold: header, order, finite vectors and cover."""
    return acquisition.orbit_readiness(t.fx_cat, orbit_names(t), parse_orbit_documents(_orbit_content(t)))
