"""Sources and sinks."""

import uuid

from pyspark.sql import functions as F

from floe.functions.rings import point
from floe.operators.cells import cells_to_tiles, tile_index, tiles_to_cells
from floe.operators.masks import polygon_edges
from floe.operators.orbits import orbit_vector_checks
from floe.queries.fixtures import DAVIS, Tables
from floe.queries.registry import day, query, r4, stamp
from floe.session import shared_dir
from floe.sources.annotations import parse_scene_names, select_rgb
from floe.sources.catalog import BOX, parse_features, search_catalog, store_catalog, stored_catalog
from floe.sources.files import hash_contents
from floe.sources.orbits import parse_orbit_documents, parse_orbit_names
from floe.sources.polygons import parse_polygons, rings_from_vertices
from floe.sources.products import parse_manifests, publish, read_published, write_product

TILE = 48


def catalogue_lines(t: Tables):
    """The scene fixture as GeoJSON features, one line each."""
    xy = lambda x, y: F.array(x, y)
    w, s, e, n = (F.col(c) for c in ("west", "south", "east", "north"))
    iso = lambda c: F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    feature = F.struct(
        F.struct(F.lit("Polygon").alias("type"), F.array(F.array(xy(w, s), xy(e, s), xy(e, n), xy(w, n), xy(w, s))).alias("coordinates")).alias("geometry"),
        F.struct(
            F.col("file_id").cast("string").alias("fileID"),
            F.concat(F.col("mission"), F.lit("_scene_"), F.col("file_id").cast("string")).alias("sceneName"),
            iso("start_time").alias("startTime"),
            iso("stop_time").alias("stopTime"),
            F.when(F.col("mission") == "S1A", "Sentinel-1A").otherwise("Sentinel-1B").alias("platform"),
            F.col("path_number").alias("pathNumber"),
            F.col("flight_direction").alias("flightDirection"),
            F.col("beam_mode").alias("beamModeType"),
            F.col("polarization").alias("polarization"),
            F.when(F.col("file_id") % 4 == 0, "SLC").otherwise("GRD_HD").alias("processingLevel"),
        ).alias("properties"),
    )
    return t.fx_cat.select(F.to_json(feature).alias("json"))


def scenes(t: Tables):
    """The scene fixture with footprint rings."""
    from floe.functions.rings import box_ring

    return t.fx_cat.withColumn("footprint", box_ring(*(F.col(c) for c in ("west", "south", "east", "north"))))


_SEARCH = """
SELECT CAST(file_id AS VARCHAR) AS file_id, strftime(start_time, '%Y-%m-%d %H:%M:%S') AS start_time, mission, path_number,
  flight_direction, polarization, west, north, {flag} AS possibly_truncated
FROM fx_cat
WHERE start_time >= TIMESTAMP '2024-01-05' AND start_time <= TIMESTAMP '2024-01-20 23:59:59'
  AND beam_mode IN ('click', 'view') AND file_id % 4 <> 0
  AND east >= 75.5 AND west <= 80.5 AND north >= -69.2 AND south <= -67.3
"""


def _search(t: Tables, cap):
    found = search_catalog(parse_features(catalogue_lines(t)), DAVIS, "2024-01-05", "2024-01-20", ["click", "view"], ["GRD_HD", "GRD_MD"], max_results=cap)
    corner = lambda axis, pick: pick(F.transform("footprint", lambda p: p[axis]))
    return found.select(
        "file_id",
        stamp("start_time").alias("start_time"),
        "mission",
        "path_number",
        "flight_direction",
        "polarization",
        corner("x", F.array_min).alias("west"),
        corner("y", F.array_max).alias("north"),
        "possibly_truncated",
    )


def tilted_scenes(t: Tables):
    """The scene fixture with tilted footprints about the south-west corners of its boxes."""
    w, s, e, n = (F.col(c) for c in ("west", "south", "east", "north"))
    a, b = (e - w) / 2, (n - s) / 2
    levels = F.when(F.col("file_id") % 4 == 0, "SLC").otherwise("GRD_HD")
    scenes = t.fx_cat.withColumns({"footprint": F.array(point(w, s - b), point(w + a, s), point(w, s + b), point(w - a, s), point(w, s - b)), "processing_level": levels})
    return scenes.withColumn("platform", F.lit("Sentinel-1")).drop(*BOX)


@query(
    "s1_stored_catalog",
    """
WITH d AS (SELECT *, greatest(0, 75.5 - west, west - 80.5) / ((east - west) / 2) AS dx, greatest(0, -69.2 - south, south + 67.3) / ((north - south) / 2) AS dy FROM fx_cat WHERE east > west AND north > south)
SELECT file_id, strftime(start_time, '%Y-%m-%d %H:%M:%S') AS start_time, strftime(start_time, '%Y-%m') AS month, round(west - (east - west) / 2, 4) AS west, round(south + (north - south) / 2, 4) AS north FROM d
WHERE start_time >= TIMESTAMP '2024-01-05' AND start_time <= TIMESTAMP '2024-01-20 23:59:59' AND beam_mode IN ('click', 'view') AND file_id % 4 <> 0 AND dx + dy <= 1""",
)
def s1_stored(t: Tables):
    """Tilted footprints, stored in order of space and time and searched there."""
    path = f"{shared_dir(t.spark).rstrip('/')}/catalogue-{uuid.uuid4().hex}"
    store_catalog(tilted_scenes(t), path)
    found = search_catalog(stored_catalog(t.spark, path), DAVIS, "2024-01-05", "2024-01-20", ["click", "view"], ["GRD_HD", "GRD_MD"])
    return found.select("file_id", stamp("start_time").alias("start_time"), "month", r4("west").alias("west"), r4("north").alias("north"))


@query("s1_scene_catalog", _SEARCH.format(flag="false"))
def s1(t: Tables):
    return _search(t, None)


@query(
    "o4_result_cap",
    f"SELECT * EXCLUDE (k) REPLACE (count(*) OVER () >= 500 AS possibly_truncated) FROM "
    f"(SELECT q.*, row_number() OVER (ORDER BY c.start_time, q.file_id) AS k FROM ({_SEARCH.format(flag='false')}) q "
    f"JOIN fx_cat c ON CAST(c.file_id AS VARCHAR) = q.file_id) WHERE k <= 500",
)
def o4(t: Tables):
    return _search(t, 500)


@query(
    "s2_tile_index",
    f"""
WITH g AS (SELECT max(vec_id) + 1 AS height, 64 AS width FROM embeddings)
SELECT ty, tx, ty * {TILE} AS row0, tx * {TILE} AS col0, least({TILE}, height - ty * {TILE}) AS h, least({TILE}, width - tx * {TILE}) AS w
FROM g, range(100000) a(ty), range(100) b(tx) WHERE ty * {TILE} < height AND tx * {TILE} < width""",
)
def s2(t: Tables):
    cast = [F.col(c).cast("bigint").alias(c) for c in ("ty", "tx", "row0", "col0", "h", "w")]
    return tile_index(t.grid(), TILE).select(*cast)


@query("s3_tiles_to_cells", "SELECT row, col, a, b FROM fx_grid")
def s3(t: Tables):
    tiles = cells_to_tiles(t.raster(), TILE, ["a", "b"])
    return tiles_to_cells(tiles, ["a", "b"]).drop("scene_id")


def scene_names(t: Tables):
    """A scene name per document, some malformed and some with days in the wrong order."""
    d = F.col("doc_id")
    first = F.date_add(F.lit("2021-01-01").cast("date"), (d % 700).cast("int"))
    second = F.when(d % 9 == 0, F.date_add(first, -3)).otherwise(F.date_add(first, 12))
    compact = lambda c: F.date_format(c, "yyyyMMdd")
    name = F.concat_ws("_", F.initcap("lang"), compact(first), F.when(d % 11 == 0, "2021").otherwise(compact(second)))
    return t.documents.select("doc_id", name.alias("scene"))


@query(
    "s4_annotated_scenes",
    r"""
WITH s AS (
  SELECT doc_id, lang, doc_id % 11 = 0 AS malformed, DATE '2021-01-01' + CAST(doc_id % 700 AS INTEGER) AS f,
    DATE '2021-01-01' + CAST(doc_id % 700 AS INTEGER) + CASE WHEN doc_id % 9 = 0 THEN -3 ELSE 12 END AS s FROM documents)
SELECT doc_id, CASE WHEN malformed THEN NULL ELSE lower(lang) END AS region,
  CASE WHEN malformed THEN NULL ELSE strftime(f, '%Y-%m-%d') END AS first_date,
  CASE WHEN malformed THEN NULL ELSE strftime(s, '%Y-%m-%d') END AS second_date,
  CASE WHEN malformed THEN 'invalid name' WHEN f >= s THEN 'dates not ordered' END AS problem
FROM s""",
)
def s4(t: Tables):
    parsed = parse_scene_names(scene_names(t))
    return parsed.select("doc_id", "region", day("first_date").alias("first_date"), day("second_date").alias("second_date"), "problem")


@query(
    "s4_rgb_file_rule",
    """
SELECT doc_id AS scene, CASE WHEN doc_id % 3 <> 0 THEN 'HH_rgb_image_d.npy' WHEN doc_id % 2 = 0 THEN 'rgb_image_d.npy' END AS file_name,
  CASE WHEN doc_id % 3 <> 0 AND doc_id % 2 = 0 AND doc_id % 5 = 0 THEN 'ambiguous'
       WHEN doc_id % 3 = 0 AND doc_id % 2 <> 0 THEN 'missing' ELSE 'ok' END AS status
FROM documents""",
)
def s4_files(t: Tables):
    d = F.col("doc_id")
    file = lambda name, content: F.struct(F.lit(name).alias("file_name"), content.alias("hash"))
    listing = F.array_compact(
        F.array(
            F.when(d % 3 != 0, file("HH_rgb_image_d.npy", F.lit("x"))),
            F.when(d % 2 == 0, file("rgb_image_d.npy", F.when(d % 5 == 0, "y").otherwise("x"))),
            file("label_map_d.npy", F.lit("z")),
        )
    )
    files = t.documents.select(d.alias("scene"), F.lit("d").alias("dates"), F.explode(listing).alias("f")).select("scene", "dates", "f.*")
    return select_rgb(files, "HH").drop("hash")


@query(
    "s5_product_manifests",
    """
SELECT product_id, region, strftime(first_time, '%Y-%m-%d') AS first_day, strftime(second_time, '%Y-%m-%d') AS second_day,
  synthetic, status, status = 'candidate_classification' AS classification_available, processing, classifier, mask_hash, ice_km2
FROM fx_prod""",
)
def s5(t: Tables):
    iso = lambda c: F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")).alias(c)
    manifest = F.struct(
        "product_id",
        "region",
        iso("first_time"),
        iso("second_time"),
        "synthetic",
        "status",
        F.create_map(F.lit("coastline"), F.col("mask_hash")).alias("resource_hashes"),
        F.struct("processing", "segmentation", "classifier", "coastline").alias("config"),
        F.struct(F.col("ice_km2").alias("candidate_fast_ice_km2")).alias("metrics"),
    )
    products = parse_manifests(t.fx_prod.select(F.to_json(manifest).alias("json")))
    return products.select(
        "product_id",
        "region",
        day("first_time").alias("first_day"),
        day("second_time").alias("second_day"),
        "synthetic",
        "status",
        "classification_available",
        "config.processing",
        "config.classifier",
        F.try_element_at("resource_hashes", F.lit("coastline")).alias("mask_hash"),
        F.col("metrics.candidate_fast_ice_km2").alias("ice_km2"),
    )


def outlines(t: Tables):
    """Outline fixture as one ring per polygon."""
    return rings_from_vertices(t.fx_vertex, ["poly_id", "surface"])


def outline_lines(t: Tables):
    """The outlines as GeoJSON polygon features, closed rings."""
    xy = F.transform("ring", lambda p: F.array(p["x"], p["y"]))
    coordinates = F.to_json(F.array(F.concat(xy, F.slice(xy, 1, 1))))
    text = F.concat(
        F.lit('{"properties":{"poly_id":'), F.col("poly_id").cast("string"), F.lit(',"surface":"'), F.col("surface"),
        F.lit('"},"geometry":{"type":"Polygon","coordinates":'), coordinates, F.lit("}}"),
    )
    return outlines(t).select(text.alias("json"))


@query(
    "s6_exclusion_polygons",
    """
WITH v AS (SELECT *, lead(x) OVER w AS nx, lead(y) OVER w AS ny, first_value(x) OVER w AS fx, first_value(y) OVER w AS fy
  FROM fx_vertex WHERE surface IN ('land', 'ice shelf', 'ice tongue', 'rumple') WINDOW w AS (PARTITION BY poly_id ORDER BY seq))
SELECT poly_id, surface, x AS x1, y AS y1, coalesce(nx, fx) AS x2, coalesce(ny, fy) AS y2 FROM v""",
)
def s6(t: Tables):
    return polygon_edges(parse_polygons(outline_lines(t)), ["poly_id", "surface"])


def orbit_names(t: Tables):
    """File names in the provider's scheme from the orbit fixture, with some that do not match."""
    part = lambda c: F.date_format(c, "yyyyMMdd'T'HHmmss")
    name = F.concat(
        F.col("mission"), F.lit("_OPER_AUX_POEORB_OPOD_"), part("creation"), F.lit("_V"), part("valid_from"), F.lit("_"), part("valid_to"),
        F.when(F.dayofmonth("day") % 7 == 0, ".TXT").when(F.col("issue") == 1, ".EOF.zip").otherwise(".EOF"),
    )
    return t.fx_orb.select(name.alias("name"))


@query(
    "s7_orbit_names",
    """
SELECT mission, strftime(creation, '%Y-%m-%d %H:%M:%S') AS creation, strftime(valid_from, '%Y-%m-%d %H:%M:%S') AS valid_from,
  strftime(valid_to, '%Y-%m-%d %H:%M:%S') AS valid_to
FROM fx_orb WHERE day(day) % 7 <> 0""",
)
def s7(t: Tables):
    times = [stamp(c).alias(c) for c in ("creation", "valid_from", "valid_to")]
    return parse_orbit_names(orbit_names(t)).select("mission", *times)


def orbit_documents(t: Tables):
    """Orbit XML per event user and day: each event is one state vector."""
    utc = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    vector = F.format_string(
        "<OSV><UTC>UTC=%s</UTC><X>%s</X><Y>%s</Y><Z>%s</Z><VX>1</VX><VY>%s</VY><VZ>3</VZ></OSV>",
        utc, F.col("value").cast("string"), F.col("user_id").cast("string"), F.col("event_id").cast("string"), (F.col("event_id") % 7).cast("string"),
    )
    file = F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMdd"))
    listed = t.events.groupBy(file.alias("file")).agg(F.array_sort(F.collect_list(F.struct("ts", "event_id", vector.alias("osv")))).alias("v"))
    body = F.array_join(F.transform("v", lambda v: v["osv"]), "")
    head = (
        "<Earth_Explorer_File><Earth_Explorer_Header><Fixed_Header><File_Type>AUX_POEORB</File_Type><Mission>Sentinel-1A</Mission>"
        "<Validity_Period><Validity_Start>UTC=2024-01-01T00:00:00</Validity_Start><Validity_Stop>UTC=2024-01-02T00:00:00</Validity_Stop></Validity_Period>"
        "</Fixed_Header></Earth_Explorer_Header><Data_Block><List_of_OSVs>"
    )
    return listed.select("file", F.concat(F.lit(head), body, F.lit("</List_of_OSVs></Data_Block></Earth_Explorer_File>")).alias("xml"))


@query(
    "s8_orbit_vectors",
    """
SELECT concat(CAST(user_id AS VARCHAR), '-', strftime(ts, '%Y%m%d')) AS file, 'AUX_POEORB' AS file_type,
  row_number() OVER (PARTITION BY user_id, strftime(ts, '%Y%m%d') ORDER BY ts, event_id) - 1 AS pos,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS t, value AS x, CAST(user_id AS DOUBLE) AS y, CAST(event_id AS DOUBLE) AS z, CAST(event_id % 7 AS DOUBLE) AS vy
FROM events""",
)
def s8(t: Tables):
    rows = parse_orbit_documents(orbit_documents(t))
    return rows.select("file", "file_type", F.col("pos").cast("bigint").alias("pos"), stamp("t").alias("t"), "x", "y", "z", "vy")


@query(
    "s9_product_sink",
    "SELECT region, concat('P', CAST(product_id % 7 AS VARCHAR)) AS pair_id, count(*) AS n, round(sum(ice_km2), 4) AS ice_km2 FROM fx_prod GROUP BY ALL",
)
def s9(t: Tables):
    """Commit products under the cluster's shared folder, then read them back."""
    import uuid

    path = f"{shared_dir(t.spark)}/products-{uuid.uuid4().hex}"
    pair = F.concat(F.lit("P"), (F.col("product_id") % 7).cast("string"))
    write_product(t.fx_prod.select("region", pair.alias("pair_id"), "product_id", "ice_km2"), path)
    back = t.spark.read.schema("product_id bigint, ice_km2 double, region string, pair_id string").parquet(path)
    return back.groupBy("region", "pair_id").agg(F.count("*").alias("n"), r4(F.sum("ice_km2")).alias("ice_km2"))


@query(
    "s9_growing_store",
    """
WITH c AS (SELECT *, product_id % 3 <> 0 AS first, CASE WHEN product_id % 11 <> 0 THEN config_hash END AS before,
    CASE WHEN product_id % 11 = 0 THEN NULL WHEN product_id % 5 = 0 THEN 'changed' ELSE config_hash END AS after FROM fx_prod)
SELECT region, CASE WHEN NOT first THEN 'process' WHEN before = after THEN 'reuse' ELSE 'conflict' END AS action, count(*) AS pairs,
  round(sum(CASE WHEN first THEN ice_km2 ELSE ice_km2 + 1 END), 2) AS published_km2 FROM c GROUP BY ALL""",
)
def s9_store(t: Tables):
    """Two batches: products of the first are reused, refused where the fingerprint changed or is missing, or joined by new ones."""
    import uuid

    root = f"{shared_dir(t.spark)}/store-{uuid.uuid4().hex}"
    number, known = F.col("product_id"), F.when(F.col("product_id") % 11 != 0, F.col("config_hash"))
    made = t.fx_prod.select("region", number.cast("string").alias("pair_id"), "product_id", "ice_km2", known.alias("fingerprint"))
    publish(made.filter("product_id % 3 <> 0"), root)
    changed = F.when(F.col("fingerprint").isNull(), None).when(number % 5 == 0, "changed").otherwise(F.col("fingerprint"))
    actions = publish(made.withColumns({"ice_km2": F.col("ice_km2") + 1, "fingerprint": changed}), root)
    found = read_published(t.spark, root).select("region", "pair_id", "ice_km2").join(actions.select("pair_id", "action"), "pair_id")
    return found.groupBy("region", "action").agg(F.count("*").alias("pairs"), F.round(F.sum("ice_km2"), 2).alias("published_km2"))


@query("s10_content_hashes", "SELECT doc_id, sha256(text) AS sha256 FROM documents")
def s10(t: Tables):
    return hash_contents(t.documents, "text").select("doc_id", "sha256")


@query(
    "a17_orbit_vector_checks",
    """
WITH v AS (SELECT user_id AS file, ts, value, lag(ts) OVER (PARTITION BY user_id ORDER BY event_id) AS before,
    row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k, count(*) OVER (PARTITION BY user_id) AS n FROM events),
f AS (SELECT file, count(*) AS vectors, bool_and(coalesce(before < ts, true)) AS rising, bool_and(value IS NOT NULL AND file % 9 <> 0) AS finite,
    max(CASE WHEN k = 1 THEN ts END) AS a, max(CASE WHEN k = n THEN ts END) AS z FROM v GROUP BY file)
SELECT file, vectors, rising, finite, a <= TIMESTAMP '2024-01-02' AND TIMESTAMP '2024-01-29' <= z AS covers,
  vectors >= 2 AND rising AND finite AND a <= TIMESTAMP '2024-01-02' AND TIMESTAMP '2024-01-29' <= z AS sound FROM f""",
)
def a17(t: Tables):
    x = F.when(F.col("user_id") % 9 != 0, F.col("value"))
    others = [F.lit(1.0).alias(c) for c in ("y", "z", "vx", "vy", "vz")]
    vectors = t.events.select(F.col("user_id").alias("file"), F.col("event_id").alias("pos"), F.col("ts").cast("timestamp").alias("t"), x.alias("x"), *others)
    files = t.events.select(F.col("user_id").alias("file")).distinct().select(
        "file", F.timestamp_micros(F.lit(1704153600000000)).alias("valid_from"), F.timestamp_micros(F.lit(1706486400000000)).alias("valid_to")
    )
    return orbit_vector_checks(vectors, files)
