"""Groups, folds, classifiers, superpixels and set operations on training tables."""

from pyspark.sql import functions as F

from floe.operators import classify, training
from floe.operators.kernel import classify_kernel, fit_kernel
from floe.operators.groups import acquisition_groups, shared_acquisitions
from floe.operators.metrics import balanced_accuracy
from floe.operators.superpixels import superpixels
from floe.operators.zonal import segment_features
from floe.queries.fixtures import Tables, scene_of
from floe.queries.registry import day, query


def repeat_scenes(t: Tables):
    return t.fx_repeat.select("scene_id", "region", F.array(day("first_date"), day("second_date")).alias("dates"))


# Scenes are taken twelve days apart, so a group is an unbroken run of twelve-day steps.
@query(
    "g1_acquisition_groups",
    """
WITH s AS (SELECT scene_id, region, date_diff('day', DATE '1990-01-01', first_date) % 12 AS phase, date_diff('day', DATE '1990-01-01', first_date) // 12 AS step FROM fx_repeat),
d AS (SELECT DISTINCT region, phase, step FROM s),
r AS (SELECT *, step - row_number() OVER (PARTITION BY region, phase ORDER BY step) AS run FROM d)
SELECT s.scene_id, s.region, min(s.scene_id) OVER (PARTITION BY s.region, s.phase, r.run) AS "group" FROM s JOIN r USING (region, phase, step)""",
)
def g1(t: Tables):
    return acquisition_groups(repeat_scenes(t))


@query(
    "u3_shared_acquisitions",
    """SELECT region, strftime(d, '%Y-%m-%d') AS date, min(scene_id) AS first_scene, count(*) AS scenes FROM
 (SELECT scene_id, region, first_date AS d FROM fx_repeat UNION ALL SELECT scene_id, region, second_date FROM fx_repeat) GROUP BY region, d HAVING count(*) > 1""",
)
def u3(t: Tables):
    return shared_acquisitions(repeat_scenes(t))


@query(
    "u1_training_union",
    "SELECT scene_id, segment_id, r, g, b, 0 AS part FROM fx_annseg WHERE scene_id % 2 = 0 UNION ALL SELECT scene_id, segment_id, r, g, b, 1 FROM fx_annseg WHERE scene_id % 2 = 1",
)
def u1(t: Tables):
    """Two sources with their columns in different order."""
    part = lambda k: t.fx_annseg.filter(F.col("scene_id") % 2 == k).withColumn("part", F.lit(k))
    return training.training_table([part(0), part(1).select("part", "b", "g", "r", "segment_id", "scene_id")])


_ROWS = "SELECT s.scene_id, s.segment_id, s.r, s.g, s.b, a.label, s.scene_id % 23 AS fold FROM fx_annseg s JOIN fx_ann a USING (scene_id, segment_id) WHERE s.segment_id > 0 AND a.label IN (0, 2, 3)"
# Class 3 only in group 5 and group 7 only class 2, so that folds lack classes.
_TRAIN = f"SELECT scene_id, segment_id, r, g, b, fold, CASE WHEN fold = 7 THEN 2 WHEN label = 3 AND fold <> 5 THEN 0 ELSE label END AS label FROM ({_ROWS})"


def training_rows(t: Tables):
    rows = training.label_segments(t.fx_annseg, t.fx_ann).withColumn("fold", F.col("scene_id") % 23)
    label = F.when(F.col("fold") == 7, 2).when((F.col("label") == 3) & (F.col("fold") != 5), 0).otherwise(F.col("label"))
    return rows.withColumn("label", label)


@query(
    "u2_unseen_classes",
    f"SELECT DISTINCT a.fold, a.label FROM ({_TRAIN}) a WHERE NOT EXISTS (SELECT 1 FROM ({_TRAIN}) b WHERE b.label = a.label AND b.fold <> a.fold)",
)
def u2(t: Tables):
    return training.unseen_classes(training_rows(t))


@query(
    "u4_missing_scenes",
    "SELECT DISTINCT doc_id AS scene_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def u4(t: Tables):
    name = F.col("doc_id").alias("scene_id")
    return training.missing_scenes(t.documents.select(name), t.labels.select(name))


@query("u4_repeated_requests", "SELECT user_id AS scene_id, count(*) AS times FROM events GROUP BY user_id HAVING count(*) > 1")
def u4_repeated(t: Tables):
    return training.repeated_requests(t.events.select(F.col("user_id").alias("scene_id")))


@query(
    "g2_logo_folds",
    f"""
WITH r AS ({_TRAIN}), f AS (SELECT DISTINCT fold FROM r)
SELECT f.fold, count(*) FILTER (r.fold <> f.fold) AS training_rows, count(*) FILTER (r.fold = f.fold) AS test_rows,
  count(DISTINCT r.label) FILTER (r.fold <> f.fold) AS training_classes,
  CASE WHEN count(DISTINCT r.label) FILTER (r.fold <> f.fold) < 2 THEN 'insufficient_training_classes' ELSE 'assessed' END AS status
FROM f, r GROUP BY f.fold""",
)
def g2(t: Tables):
    return classify.logo_folds(training_rows(t))


_NEAREST = "round(pow(x.r - m.r, 2) + pow(x.g - m.g, 2) + pow(x.b - m.b, 2), 6)"
_PREDICTED = f"""
SELECT scene_id, segment_id, fold, label, pred FROM (
  SELECT x.scene_id, x.segment_id, x.fold, x.label, m.label AS pred, row_number() OVER (PARTITION BY x.scene_id, x.segment_id ORDER BY {_NEAREST}, m.label) AS k
  FROM ({_TRAIN}) x JOIN (SELECT f.fold, r.label, avg(r.r) AS r, avg(r.g) AS g, avg(r.b) AS b FROM (SELECT DISTINCT fold FROM ({_TRAIN})) f JOIN ({_TRAIN}) r ON r.fold <> f.fold GROUP BY f.fold, r.label) m
  ON m.fold = x.fold) WHERE k = 1"""


@query("g2_logo_predictions", _PREDICTED)
def g2_predictions(t: Tables):
    return classify.logo_predictions(training_rows(t)).select("scene_id", "segment_id", "fold", "label", "pred")


@query(
    "g4_nearest_centroid",
    f"""
WITH s AS (SELECT scene_id, segment_id, avg(r) AS r, avg(g) AS g, avg(b) AS b FROM fx_seg WHERE segment_id > 0 GROUP BY ALL),
m AS (SELECT label, avg(r) AS r, avg(g) AS g, avg(b) AS b FROM ({_TRAIN}) GROUP BY label)
SELECT scene_id, segment_id, predicted FROM (SELECT x.scene_id, x.segment_id, m.label AS predicted,
  row_number() OVER (PARTITION BY x.scene_id, x.segment_id ORDER BY {_NEAREST}, m.label) AS k FROM s x, m) WHERE k = 1""",
)
def g4(t: Tables):
    return classify.classify_nearest(seg_features(t), classify.centroids(training_rows(t))).select("scene_id", "segment_id", "predicted")


def seg_features(t: Tables):
    return segment_features(t.fx_seg).withColumnsRenamed({f"mean_{c}": c for c in "rgb"})


@query(
    "g5_classify_cells",
    f"""
WITH s AS (SELECT scene_id, segment_id, avg(r) AS r, avg(g) AS g, avg(b) AS b FROM fx_seg WHERE segment_id > 0 GROUP BY ALL),
m AS (SELECT label, avg(r) AS r, avg(g) AS g, avg(b) AS b FROM ({_TRAIN}) GROUP BY label),
p AS (SELECT scene_id, segment_id, predicted FROM (SELECT x.scene_id, x.segment_id, m.label AS predicted,
  row_number() OVER (PARTITION BY x.scene_id, x.segment_id ORDER BY {_NEAREST}, m.label) AS k FROM s x, m) WHERE k = 1)
SELECT c.row, c.col, CASE WHEN (c.row + c.col) % 17 = 0 THEN 1 WHEN c.r % 9 = 0 OR c.segment_id = 0 THEN 255 ELSE coalesce(p.predicted, 255) END AS cls
FROM fx_seg c LEFT JOIN p USING (scene_id, segment_id)""",
)
def g5(t: Tables):
    predicted = classify.classify_nearest(seg_features(t), classify.centroids(training_rows(t)))
    cells = t.fx_seg.withColumns({"valid": F.col("r") % 9 != 0, "excluded": (F.col("row") + F.col("col")) % 17 == 0})
    return classify.classify_cells(cells, predicted).select("row", "col", "cls")


@query("g3_forest_classifier")
def g3(t: Tables):
    """Forest trained on annotated segments and applied to every segment."""
    rows = training_rows(t)
    return classify.classify_forest(seg_features(t), classify.fit_forest(rows)).select("scene_id", "segment_id", "predicted")


@query("g3_forest_site_holdout")
def g3_sites(t: Tables):
    """Forest assessed by holding out each of two sites."""
    rows = training_rows(t).withColumn("fold", F.col("scene_id") % 2)
    return balanced_accuracy(classify.assess_forest(rows, [0, 1]))


@query("g3_kernel_classifier", f"SELECT scene_id, segment_id, label AS predicted FROM ({_ROWS}) WHERE scene_id % 2 = 1")
def g3_kernel(t: Tables):
    """Kernel machine of even scenes on odd ones; class 0 lies within the ring of class 2, class 3 above it, far apart."""
    part, angle = F.col("g") / 255, F.col("r") * (3.141592653589793 / 128)
    radius = F.when(F.col("label") == 2, 80 + 30 * part).otherwise(30 * part)
    base = F.when(F.col("label") == 3, 180).otherwise(30)
    rows = training.label_segments(t.fx_annseg, t.fx_ann).select(
        "scene_id", "segment_id", "label", (128 + radius * F.cos(angle)).alias("r"), (128 + radius * F.sin(angle)).alias("g"), (base + F.col("b") % 40).alias("b")
    )
    model = fit_kernel(rows.filter("scene_id % 2 = 0"))
    return classify_kernel(rows.filter("scene_id % 2 = 1"), model).select("scene_id", "segment_id", "predicted")


@query(
    "g6_validate_features",
    f"""SELECT count(*) AS rows, count(*) FILTER (r % 50 = 0) AS bad_features, count(*) FILTER (g % 40 = 1) AS bad_labels,
 count(DISTINCT label) FILTER (g % 40 <> 1) AS classes, false AS sound, 'mean_RGB_uint8' AS features FROM ({_TRAIN})""",
)
def g6(t: Tables):
    spoiled = training_rows(t).withColumns(
        {"r": F.when(F.col("r") % 50 == 0, 300.5).otherwise(F.col("r")), "label": F.when(F.col("g") % 40 == 1, 1).otherwise(F.col("label"))}
    )
    return training.validate_features(spoiled)


def segmented(t: Tables):
    """Superpixels of the RGB fixture laid out as one raster."""
    shape = {"height": t.shape().scalar(), "width": F.lit(62).cast("bigint")}
    cells = t.fx_seg.select(scene_of("row"), "row", "col", "r", "g", "b", (F.col("r") % 9 != 0).alias("valid"))
    return superpixels(cells.withColumns(shape), n_segments=400, compactness=5.0, rounds=3)


_PULL = "(5.0 / sqrt(n.h * 62 / 400.0)) * (5.0 / sqrt(n.h * 62 / 400.0))"


def _assign_sql(seeds: str) -> str:
    """Each valid cell with the closest seed of the nine squares around its own."""
    square = lambda c: f"(c.{c} - s.{c}) * (c.{c} - s.{c})"
    distance = f"round({square('r')} + {square('g')} + {square('b')} + ({square('row')} + {square('col')}) * {_PULL}, 9)"
    return f"""SELECT c.row, c.col, c.r, c.g, c.b, arg_min(s.id, ({distance}, s.id)) AS id FROM cell c, n JOIN {seeds} s
      ON s.sy BETWEEN c.sy - 1 AND c.sy + 1 AND s.sx BETWEEN c.sx - 1 AND c.sx + 1 GROUP BY c.row, c.col, c.r, c.g, c.b"""


def _superpixel_sql(rounds: int) -> str:
    """The same rounds of assignment and averaging, spelled out one after another."""
    home = "CAST(floor((row + 0.5) / sqrt(n.h * 62 / 400.0)) AS BIGINT) AS sy, CAST(floor((col + 0.5) / sqrt(n.h * 62 / 400.0)) AS BIGINT) AS sx"
    means = ", ".join(f"avg({c}) AS {c}" for c in ("row", "col", "r", "g", "b"))
    parts = [
        "n AS (SELECT CAST(max(vec_id) + 1 AS DOUBLE) AS h FROM embeddings)",
        f"cell AS MATERIALIZED (SELECT row, col, r, g, b, {home} FROM fx_seg, n WHERE r % 9 <> 0)",
        f"s0 AS MATERIALIZED (SELECT sy, sx, sy * CAST(ceil(62 / sqrt(any_value(n.h) * 62 / 400.0)) AS BIGINT) + sx + 1 AS id, {means} FROM cell, n GROUP BY sy, sx)",
    ]
    for k in range(rounds):
        parts.append(f"a{k} AS MATERIALIZED ({_assign_sql(f's{k}')})")
        parts.append(f"s{k + 1} AS MATERIALIZED (SELECT s0.sy, s0.sx, m.* FROM (SELECT id, {means} FROM a{k} GROUP BY id) m JOIN s0 ON s0.id = m.id)")
    return f"""WITH {", ".join(parts)}
SELECT x.row, x.col, coalesce(f.id, 0) AS segment_id FROM fx_seg x LEFT JOIN ({_assign_sql(f's{rounds}')}) f ON f.row = x.row AND f.col = x.col"""


@query("g7_superpixels", _superpixel_sql(3))
def g7(t: Tables):
    return segmented(t).select("row", "col", "segment_id")
