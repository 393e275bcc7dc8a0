"""Zonal statistics, extent, change and outline metrics, elevation reports."""

from pyspark.sql import functions as F

from floe.operators import metrics, zonal
from floe.operators.masks import surface_counts, total_bounds
from floe.operators.products import conflicting_names, date_matched
from floe.operators.terrain import combine_elevation, coverage_report, exact_percentiles, merge_report
from floe.operators.training import training_regions, training_report
from floe.queries.cellwise import area_sql, with_area
from floe.queries.fixtures import Tables
from floe.queries.registry import query, r4
from floe.queries.sources import outlines

_AREA = f"SELECT *, {area_sql('row', 'col')} AS area_km2 FROM"


def class_pairs(t: Tables):
    return with_area(t.fx_cls)


@query(
    "a5_change_metrics",
    f"""
SELECT round(sum(CASE WHEN prev IN (0, 2, 3) AND curr IN (0, 2, 3) THEN area_km2 ELSE 0 END), 4) AS common_km2,
  round(sum(CASE WHEN prev = 0 AND curr IN (2, 3) THEN area_km2 ELSE 0 END), 4) AS gain_km2,
  round(sum(CASE WHEN prev IN (2, 3) AND curr = 0 THEN area_km2 ELSE 0 END), 4) AS loss_km2,
  round(sum(CASE WHEN prev IN (2, 3) AND curr IN (2, 3) THEN area_km2 ELSE 0 END), 4) AS persistent_km2,
  round(sum(CASE WHEN prev = 0 AND curr IN (2, 3) THEN area_km2 WHEN prev IN (2, 3) AND curr = 0 THEN -area_km2 ELSE 0 END), 4) AS net_km2
FROM ({_AREA} fx_cls)""",
)
def a5(t: Tables):
    result = metrics.change_metrics(metrics.change_cells(class_pairs(t)), [])
    return result.select(*[r4(c).alias(c) for c in result.columns])


@query(
    "a5_change_cells",
    """SELECT row, col, CASE WHEN prev NOT IN (0, 2, 3) OR curr NOT IN (0, 2, 3) THEN 255 WHEN prev = 0 AND curr = 0 THEN 0
 WHEN prev = 0 THEN 2 WHEN curr = 0 THEN 3 ELSE 1 END AS change FROM fx_cls""",
)
def a5_cells(t: Tables):
    return metrics.change_cells(t.fx_cls).select("row", "col", "change")


@query("a1_segment_features", "SELECT scene_id, segment_id, round(avg(r), 4) AS mean_r, round(avg(g), 4) AS mean_g, round(avg(b), 4) AS mean_b, count(*) AS cells FROM fx_seg WHERE segment_id > 0 GROUP BY ALL")
def a1(t: Tables):
    found = zonal.segment_features(t.fx_seg)
    return found.select("scene_id", "segment_id", *[r4(f"mean_{c}").alias(f"mean_{c}") for c in "rgb"], "cells")


def labelled_cells(t: Tables):
    """Segment cells with manual labels that agree in some segments and are mixed in others."""
    k = F.col("segment_id")
    label = F.when(F.col("r") % 5 == 0, 255).when((k % 3 == 0) & (F.col("col") % 2 == 0), 2).when(F.col("col") == 7, 3).otherwise((k % 2) * 2)
    return t.fx_seg.withColumn("label", label.cast("int"))


_LABELLED = """SELECT scene_id, segment_id, CASE WHEN r % 5 = 0 THEN 255 WHEN segment_id % 3 = 0 AND col % 2 = 0 THEN 2 WHEN col = 7 THEN 3 ELSE (segment_id % 2) * 2 END AS label FROM fx_seg"""


@query(
    "a2_majority_labels",
    f"""
WITH v AS (SELECT scene_id, segment_id, label, count(*) AS n FROM ({_LABELLED}) WHERE segment_id > 0 AND label IN (0, 2, 3) GROUP BY ALL),
r AS (SELECT *, sum(n) OVER (PARTITION BY scene_id, segment_id) AS labelled, row_number() OVER (PARTITION BY scene_id, segment_id ORDER BY n DESC, label) AS k FROM v)
SELECT scene_id, segment_id, label, CAST(labelled AS BIGINT) AS labelled, round(n / labelled, 6) AS purity FROM r WHERE k = 1 AND n / labelled >= 0.9""",
)
def a2(t: Tables):
    found = zonal.majority_labels(labelled_cells(t))
    return found.withColumn("purity", r4("purity", 6))


@query(
    "a3_class_counts",
    "SELECT scene_id, label, count(*) AS segments FROM fx_ann WHERE label IS NOT NULL GROUP BY ALL UNION ALL SELECT NULL, label, count(*) FROM fx_ann WHERE label IS NOT NULL GROUP BY label",
)
def a3(t: Tables):
    return zonal.class_counts(t.fx_ann.filter("label is not null"))


@query(
    "a4_extent_metrics",
    f"""SELECT row % 10 AS band, round(sum(CASE WHEN curr IN (2, 3) THEN area_km2 ELSE 0 END), 4) AS ice_km2,
 round(sum(CASE WHEN curr IN (0, 2, 3) THEN area_km2 ELSE 0 END), 4) AS observed_km2, count(*) FILTER (curr = 255) AS unknown_cells FROM ({_AREA} fx_cls) GROUP BY row % 10""",
)
def a4(t: Tables):
    found = metrics.extent_metrics(class_pairs(t).withColumn("band", F.col("row") % 10), ["band"], "curr")
    return found.select("band", r4("ice_km2").alias("ice_km2"), r4("observed_km2").alias("observed_km2"), "unknown_cells")


_OVERLAY = "SELECT *, in_domain AND validity <> 2 AND cls <> 1 AS ocean, in_domain AND validity = 1 AND cls IN (0, 2, 3) AS assessed FROM fx_val"


@query("j18_overlay", f"SELECT row, col, ocean, assessed FROM ({_OVERLAY})")
def j18(t: Tables):
    return metrics.overlay(t.fx_val).select("row", "col", "ocean", "assessed")


@query(
    "a6_outline_assessment",
    f"""
WITH s AS (SELECT row % 5 AS band,
  sum(CASE WHEN assessed AND cls IN (2, 3) AND in_reference THEN area_km2 ELSE 0 END) AS tp,
  sum(CASE WHEN assessed AND cls IN (2, 3) AND NOT in_reference THEN area_km2 ELSE 0 END) AS fp,
  sum(CASE WHEN assessed AND cls = 0 AND in_reference THEN area_km2 ELSE 0 END) AS fn,
  sum(CASE WHEN assessed AND cls = 0 AND NOT in_reference THEN area_km2 ELSE 0 END) AS tn,
  sum(CASE WHEN ocean THEN area_km2 ELSE 0 END) AS oc, sum(CASE WHEN ocean AND NOT assessed THEN area_km2 ELSE 0 END) AS un
  FROM ({_AREA} ({_OVERLAY})) GROUP BY row % 5)
SELECT band, round(tp, 4) AS tp_km2, round(fp, 4) AS fp_km2, round(fn, 4) AS fn_km2, round(tn, 4) AS tn_km2, round(oc, 4) AS ocean_km2,
  round(un, 4) AS unassessed_km2, round(tp / nullif(tp + fp, 0), 6) AS "precision", round(tp / nullif(tp + fn, 0), 6) AS recall, round(tp / nullif(tp + fp + fn, 0), 6) AS iou,
  CAST(NULL AS VARCHAR) AS problem FROM s""",
)
def a6(t: Tables):
    cells = metrics.overlay(with_area(t.fx_val)).withColumn("band", F.col("row") % 5)
    found = metrics.outline_assessment(cells, ["band"])
    rounded = {c: r4(c) for c in found.columns if c.endswith("_km2")} | {c: r4(c, 6) for c in ("precision", "recall", "iou")}
    return found.withColumns(rounded)


@query(
    "a7_confusion",
    """SELECT f.fold, l.c AS label, p.c AS pred, count(d.fold) AS segments FROM (SELECT DISTINCT fold FROM fx_fold) f, (VALUES (0), (2), (3)) l(c), (VALUES (0), (2), (3)) p(c)
LEFT JOIN fx_fold d ON d.fold = f.fold AND d.label = l.c AND d.pred = p.c GROUP BY ALL""",
)
def a7(t: Tables):
    return metrics.confusion(t.fx_fold)


@query(
    "a8_balanced_accuracy",
    """SELECT fold, round(avg(recall), 6) AS balanced_accuracy, count(*) AS classes FROM
 (SELECT fold, label, count(*) FILTER (label = pred) / count(*) AS recall FROM fx_fold GROUP BY ALL) GROUP BY fold""",
)
def a8(t: Tables):
    return metrics.balanced_accuracy(t.fx_fold).withColumn("balanced_accuracy", r4("balanced_accuracy", 6))


@query("a9_valid_fraction", "SELECT label, round(count(a) / count(*), 6) AS valid_fraction FROM fx_grid GROUP BY label")
def a9(t: Tables):
    found = zonal.valid_fraction(t.fx_grid, F.col("a").isNotNull(), ["label"])
    return found.withColumn("valid_fraction", r4("valid_fraction", 6))


@query("a10_segment_count", "SELECT scene_id, count(DISTINCT segment_id) FILTER (segment_id > 0) AS segments FROM fx_seg GROUP BY scene_id")
def a10(t: Tables):
    return zonal.segment_count(t.fx_seg, ["scene_id"])


@query(
    "a11_elevation_coverage",
    """SELECT CASE WHEN land THEN 'land' ELSE 'ocean' END AS surface, count(*) AS samples, count(*) - count(terrain) AS missing,
 round(100 * (count(*) - count(terrain)) / count(*), 6) AS missing_percent FROM fx_dem GROUP BY land""",
)
def a11(t: Tables):
    return coverage_report(t.fx_dem).withColumn("missing_percent", r4("missing_percent", 6))


@query(
    "a12_elevation_percentiles",
    """SELECT land, CAST(p AS DOUBLE) AS p, round(v, 4) AS value FROM (SELECT land, unnest([0, 0.01, 0.5, 0.99, 1]) AS p,
 unnest(quantile_cont(CAST(terrain AS DOUBLE), [0, 0.01, 0.5, 0.99, 1])) AS v FROM fx_dem GROUP BY land)""",
)
def a12(t: Tables):
    found = exact_percentiles(t.fx_dem, F.col("terrain"), [0, 0.01, 0.5, 0.99, 1], ["land"])
    return found.withColumn("value", r4("value"))


@query(
    "j22_combine_elevation",
    """SELECT row, col, CASE WHEN land THEN terrain ELSE geoid END AS elevation,
 CASE WHEN land AND terrain IS NULL THEN 'missing terrain on land' WHEN NOT land AND geoid IS NULL THEN 'missing geoid on ocean' END AS problem FROM fx_dem""",
)
def j22(t: Tables):
    return combine_elevation(t.fx_dem).select("row", "col", "elevation", "problem")


@query(
    "j22_merge_report",
    """SELECT row % 7 AS band, count(*) FILTER (land) AS land_cells, count(*) FILTER (NOT land) AS ocean_cells, count(*) FILTER (land AND terrain IS NULL) AS missing_land,
 count(*) FILTER (NOT land AND geoid IS NULL) AS missing_ocean FROM fx_dem GROUP BY row % 7""",
)
def j22_report(t: Tables):
    return merge_report(combine_elevation(t.fx_dem).withColumn("band", F.col("row") % 7), ["band"])


@query("a13_surface_counts", "SELECT surface, count(*) AS polygons FROM fx_outline GROUP BY surface")
def a13(t: Tables):
    return surface_counts(outlines(t))


@query("a14_total_bounds", "SELECT surface, min(x0) AS west, min(y0) AS south, max(x0 + size) AS east, max(y0 + 2 * size) AS north FROM fx_outline GROUP BY surface")
def a14(t: Tables):
    return total_bounds(outlines(t), ["surface"])


@query("a15_training_regions", "SELECT DISTINCT lower(region) AS region FROM fx_doc")
def a15(t: Tables):
    return training_regions(t.fx_doc)


@query(
    "a16_training_report",
    """
WITH s AS (SELECT region AS scene_id, label FROM fx_doc WHERE label IS NOT NULL)
SELECT scene_id, count(*) AS segments, 1 AS scenes, count(*) FILTER (label = 0) AS class_0, count(*) FILTER (label = 2) AS class_2, count(*) FILTER (label = 3) AS class_3,
  CASE WHEN count(DISTINCT label) < 2 THEN 'needs two classes' END AS problem FROM s GROUP BY scene_id
UNION ALL
SELECT NULL, count(*), count(DISTINCT scene_id), count(*) FILTER (label = 0), count(*) FILTER (label = 2), count(*) FILTER (label = 3),
  CASE WHEN count(DISTINCT label) < 2 THEN 'needs two classes' END FROM s""",
)
def a16(t: Tables):
    return training_report(t.fx_doc.filter("label is not null").select(F.col("region").alias("scene_id"), "label"))


@query(
    "o5_paint_masks",
    """SELECT row, col, mask_id FROM (SELECT *, row_number() OVER (PARTITION BY row, col ORDER BY area, mask_id DESC) AS k FROM fx_mask) WHERE k = 1""",
)
def o5(t: Tables):
    return zonal.paint_masks(t.fx_mask, ["row", "col"])


@query(
    "j17_date_match",
    "SELECT product_id FROM fx_prod WHERE CAST(second_time AS DATE) = CAST(created_time - INTERVAL 3 DAY AS DATE) AND CAST(first_time AS DATE) = DATE '1997-03-01' + CAST(product_id % 20 AS INTEGER)",
)
def j17(t: Tables):
    first = F.date_add(F.lit("1997-03-01").cast("date"), (F.col("product_id") % 20).cast("int"))
    second = F.date_add(F.to_date("created_time"), -3)
    return date_matched(t.fx_prod, first, second).select("product_id")


@query(
    "j17_conflicting_names",
    "SELECT product_id FROM fx_prod WHERE product_id % 3 = 0 OR product_id % 7 = 0",
)
def j17_names(t: Tables):
    """References named after their days, some file or folder names off by one day."""
    p = F.col("product_id")
    compact = lambda c: F.date_format(c, "yyyyMMdd")
    later = F.date_add(F.to_date("second_time"), 1)
    name = lambda wrong: F.concat(F.lit("ref_"), compact("first_time"), F.lit("_"), F.when(wrong, compact(later)).otherwise(compact("second_time")), F.lit("_v2"))
    references = t.fx_prod.select(
        "product_id",
        F.to_date("first_time").alias("first_date"),
        F.to_date("second_time").alias("second_date"),
        F.when(p % 5 == 0, "plain").otherwise(name(p % 3 == 0)).alias("file_name"),
        name((p % 7 == 0) | ((p % 3 == 0) & (p % 5 == 0))).alias("folder_name"),
    )
    return conflicting_names(references).select("product_id")
