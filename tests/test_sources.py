import hashlib
import json
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from floe.operators.orbits import match_orbits, match_sound_orbits, orbit_vector_checks
from floe.functions.rings import meets_box
from floe.operators.terrain import combine_elevation, coverage_report, exact_percentiles, strict_elevation
from floe.sources import annotations, catalog, files, orbits, polygons, products, rasters

NAME = "S1A_OPER_AUX_POEORB_OPOD_20211101T000000_V20211009T225942_20211011T005942.EOF"


def test_catalogue_document(spark, tmp_path):
    feature = {
        "type": "Feature",
        "geometry": {"type": "Polygon", "coordinates": [[[75, -70], [81, -70], [81, -66], [75, -66], [75, -70]]]},
        "properties": {"fileName": "f.zip", "startTime": "2021-10-31T23:59:58Z", "stopTime": "2021-11-01T00:01:02Z", "platform": "Sentinel-1A", "pathNumber": 7,
                       "flightDirection": "ASCENDING", "beamModeType": "EW", "polarization": "HH+HV", "processingLevel": "GRD_HD", "url": "https://host/S1A_EW_x.zip?token=1"},
    }
    (tmp_path / "scenes.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [feature]}))
    scenes = catalog.read_catalog(spark, str(tmp_path))
    s = scenes.first()
    assert (s.file_id, s.mission, s.path_number, len(s.footprint)) == ("f.zip", "S1A", 7, 5)
    assert s.start_time == datetime(2021, 10, 31, 23, 59, 58)
    search = lambda end, cap: catalog.search_catalog(scenes, (75.5, -69.2, 80.5, -67.3), "2021-10-01", end, ["EW"], ["GRD_HD"], max_results=cap)
    assert search("2021-10-31", 1).first().possibly_truncated and not search("2021-10-31", 2).first().possibly_truncated
    assert search("2021-10-30", None).isEmpty()


def test_orbit_names_and_coverage(spark):
    names = spark.createDataFrame([(NAME,), (NAME + ".zip",), ("index.html",), (NAME.replace("POEORB", "RESORB"),)], "name string")
    parsed = orbits.parse_orbit_names(names)
    assert parsed.count() == 2 and parsed.first().valid_from == datetime(2021, 10, 9, 22, 59, 42)
    start = datetime(2021, 10, 10, 12)
    scene = lambda k, mission="S1A", at=start, length=64: (k, mission, at, at + timedelta(seconds=length))
    scenes = spark.createDataFrame(
        [scene("in"), scene("craft", "S1B"), scene("edge", at=datetime(2021, 10, 11, 0, 58, 0)), scene("late", at=datetime(2021, 10, 11, 0, 58, 0), length=63), scene("bad", length=0), scene("who", "XYZ")],
        "file_id string, mission string, start_time timestamp, stop_time timestamp",
    )
    newer = NAME.replace("20211101T", "20211102T")
    listing = orbits.parse_orbit_names(spark.createDataFrame([(NAME,), (newer,)], "name string"))
    got = {r.file_id: (r.status, r.orbit_name) for r in match_orbits(scenes, listing).collect()}
    assert got["in"] == ("matched", newer)
    assert got["craft"] == ("no_orbit", None) and got["edge"][0] == "no_orbit"
    assert got["bad"][0] == "invalid_interval" and got["who"][0] == "unknown_mission"
    assert got["late"][0] == "no_orbit"


def document(times, mission="Sentinel-1A", x="1.0"):
    body = "".join(f"<OSV><UTC>UTC={t:%Y-%m-%dT%H:%M:%S.%f}</UTC><X>{x}</X><Y>2</Y><Z>3</Z><VX>4</VX><VY>5</VY><VZ>6</VZ></OSV>" for t in times)
    return (
        f"<Earth_Explorer_File><Earth_Explorer_Header><Fixed_Header><File_Type>AUX_POEORB</File_Type><Mission>{mission}</Mission><Validity_Period>"
        "<Validity_Start>UTC=2021-10-09T22:59:42</Validity_Start><Validity_Stop>UTC=2021-10-11T00:59:42</Validity_Stop></Validity_Period></Fixed_Header></Earth_Explorer_Header>"
        f"<Data_Block><List_of_OSVs>{body}</List_of_OSVs></Data_Block></Earth_Explorer_File>"
    )


def test_orbit_files(spark, tmp_path):
    a, z = datetime(2021, 10, 9, 22, 0), datetime(2021, 10, 11, 2, 0)
    cases = {"good": document([a, z]), "short": document([a]), "order": document([z, a]), "gap": document([a + timedelta(hours=3), z]), "nan": document([a, z], x="NaN")}
    for name, text in cases.items():
        (tmp_path / f"{name}.EOF").write_text(text)
    vectors = orbits.read_orbit_vectors(spark, str(tmp_path))
    window = spark.createDataFrame([(f"{n}.EOF", datetime(2021, 10, 9, 23), datetime(2021, 10, 11)) for n in [*cases, "empty"]], "file string, valid_from timestamp, valid_to timestamp")
    got = {r.file[:-4]: (r.sound, r.vectors, r.rising, r.finite, r.covers) for r in orbit_vector_checks(vectors, window).collect()}
    assert got["good"] == (True, 2, True, True, True)
    assert got["short"][:2] == (False, 1) and got["empty"][:2] == (False, 0)
    assert not got["order"][2] and not got["nan"][3] and not got["gap"][4]
    named = spark.createDataFrame([("good.EOF", "S1B", datetime(2021, 10, 9, 22, 59, 42), datetime(2021, 10, 11))], "name string, mission string, valid_from timestamp, valid_to timestamp")
    assert orbits.header_problems(vectors, named).first().reasons == ["spacecraft", "validity"]


def test_newest_sound_file_wins(spark):
    """The newest file covers by name; what it holds decides whether an older one is taken."""
    a, z = datetime(2021, 10, 9, 22, 59, 42), datetime(2021, 10, 11, 0, 59, 42)
    at = lambda k: NAME.replace("20211101T", f"202111{k:02d}T")
    contents = {
        at(1): document([a, z]),
        at(2): document([a, z - timedelta(hours=6)]),  # ends early
        at(3): document([z, a]),
        at(4): document([a, z], mission="Sentinel-1B"),
        at(5): document([a, z], x="NaN"),
        at(6): document([a]),
        at(7): document([]),
    }
    listing = spark.createDataFrame([(n + (".zip" if n == at(2) else ""),) for n in [*contents, at(8)]], "name string")
    vectors = orbits.parse_orbit_documents(spark.createDataFrame(list(contents.items()), "file string, xml string"))
    scene = lambda k, hour, mission="S1A", day=10: (k, mission, datetime(2021, 10, day, hour), datetime(2021, 10, day, hour, 1))
    scenes = spark.createDataFrame(
        [scene("noon", 12), scene("night", 23), scene("other", 12, day=12), scene("craft", 12, "S1D"), scene("who", 12, None)],
        "file_id string, mission string, start_time timestamp, stop_time timestamp",
    )
    got = {r.file_id: (r.status, r.orbit_name, r.candidates, r.sound) for r in match_sound_orbits(scenes, orbits.parse_orbit_names(listing), vectors).collect()}
    assert got["noon"] == ("matched", at(2) + ".zip", 8, 2)
    assert got["night"] == ("matched", at(1), 8, 1)
    assert got["other"][0] == got["craft"][0] == "no_orbit" and got["who"][0] == "unknown_mission"
    broken = vectors.filter(~vectors.file.isin(at(1), at(2)))
    got = {r.file_id: r.status for r in match_sound_orbits(scenes, orbits.parse_orbit_names(listing), broken).collect()}
    assert got["noon"] == got["night"] == "unsound_orbit"
    none = match_sound_orbits(scenes, orbits.parse_orbit_names(listing), vectors.limit(0))
    assert none.filter("status = 'unsound_orbit'").count() == 2


def test_manifests_are_found_in_folders(spark, tmp_path):
    for k, folder in enumerate(["a", "b/c"]):
        (tmp_path / folder).mkdir(parents=True)
        record = {"region": "Davis", "first_time": "2021-10-10T00:00:00Z", "second_time": f"2021-10-2{k}T00:00:00Z", "synthetic": False, "status": "segmentation_only", "resource_hashes": {"coastline": "x"}, "unknown": 1}
        (tmp_path / folder / "manifest.json").write_text(json.dumps(record, indent=2))
    (tmp_path / "a" / "other.json").write_text("{}")
    found = products.read_products(spark, str(tmp_path))
    assert found.count() == 2
    row = found.orderBy("second_time").first()
    assert row.second_time == datetime(2021, 10, 20) and row.resource_hashes == {"coastline": "x"} and row.classification_available is False


def test_sink_never_overwrites(spark, tmp_path):
    df = spark.createDataFrame([("Davis", "p1", 1.0), ("Davis", "p2", 2.0)], "region string, pair_id string, v double")
    path = str(tmp_path / "out")
    products.write_product(df, path)
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(Exception, match="(?i)exists"):
        products.write_product(df, path)


def test_file_hashes(spark, tmp_path):
    for suffix in ("shp", "dbf"):
        (tmp_path / f"v.{suffix}").write_bytes(suffix.encode() * 100)
    got = {r.file_name: r.sha256 for r in files.hash_files(spark, str(tmp_path), "v.*").collect()}
    assert got == {f"v.{s}": hashlib.sha256(s.encode() * 100).hexdigest() for s in ("shp", "dbf")}


def test_polygon_features(spark, tmp_path):
    square = [[[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]]
    feature = lambda surface, kind, xy: {"type": "Feature", "properties": {"poly_id": 1, "surface": surface}, "geometry": {"type": kind, "coordinates": xy}}
    write = lambda *fs: (tmp_path / "c.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": list(fs)}))
    write(feature("land", "Polygon", square), feature("ice shelf", "MultiPolygon", [square, square]), feature("ocean", "Polygon", square))
    assert polygons.read_polygons(spark, str(tmp_path)).count() == 3
    assert polygons.read_polygons(spark, None).isEmpty()
    write(feature("ocean", "Polygon", square))
    with pytest.raises(ValueError):
        polygons.read_polygons(spark, str(tmp_path))
    write(feature("land", "LineString", [[0, 0], [1, 1]]))
    with pytest.raises(Exception, match="not a polygon"):
        polygons.read_polygons(spark, str(tmp_path)).collect()


def test_annotated_names(spark):
    names = ["prydz_20210129_20210210", "prydz_20210210_20210129", "x y_20210129_20210210", "a_20219929_20210210"]
    got = annotations.parse_scene_names(spark.createDataFrame([(n,) for n in names], "scene string"))
    assert {r.scene: r.problem for r in got.collect()} == dict(zip(names, [None, "dates not ordered", "invalid name", "invalid name"]))


def test_unprefixed_file_is_never_hv(spark):
    rows = spark.createDataFrame([("s", "d", "rgb_image_d.npy", "1"), ("u", "d", "HV_rgb_image_d.npy", "2"), ("u", "d", "rgb_image_d.npy", "1")], "scene string, dates string, file_name string, hash string")
    got = {r.scene: r.status for r in annotations.select_rgb(rows, "HV").collect()}
    assert got == {"s": "missing", "u": "ambiguous"}


def test_synthetic_pair_is_stable(spark):
    first = rasters.synthetic_pair(spark, 40, 30, 11)
    again = rasters.synthetic_pair(spark, 40, 30, 11).repartition(7)
    key = lambda df: sorted((r.row, r.col, r.a, r.b) for r in df.filter("a is not null").collect())
    assert key(first) == key(again)
    halves = first.filter("row >= 10").selectExpr("avg(if(col < 15, abs(a - b), null)) l", "avg(if(col >= 15, abs(a - b), null)) r", "avg(a) m", "stddev(a) s").first()
    assert halves.l == 0 and halves.r > 1 and abs(halves.m + 15) < 0.3 and abs(halves.s - 2) < 0.2
    assert first.filter("row < 10 and (a is not null or b is not null)").isEmpty()


def test_tile_reader_checks(spark, tmp_path):
    columns = "scene_id string, crs string, ty int, tx int, row0 int, col0 int, h int, w int, height int, width int, values array<float>"
    rows = lambda crs, n: spark.createDataFrame([("s", crs, 0, 0, 0, 0, 1, 2, 1, 2, [1.0] * n)], columns)
    for k, (crs, n, ok) in enumerate([("EPSG:3031", 2, True), (None, 2, False), ("EPSG:3031", 3, False)]):
        rows(crs, n).write.parquet(str(tmp_path / str(k)))
        read = lambda: rasters.read_tiles(spark, str(tmp_path / str(k))).collect()
        if ok:
            assert len(read()) == 1
        else:
            with pytest.raises(Exception, match="CRS|cell count"):
                read()
    spark.range(1).write.parquet(str(tmp_path / "no"))
    with pytest.raises(ValueError):
        rasters.read_tiles(spark, str(tmp_path / "no"))


def test_elevation_rules(spark):
    rows = [(0, True, 123.0, 18.0), (1, False, 50.0, 19.0), (2, True, None, 19.0), (3, False, 1.0, None)]
    merged = combine_elevation(spark.createDataFrame(rows, "k int, land boolean, terrain double, geoid double"))
    got = {r.k: (r.elevation, r.problem) for r in merged.collect()}
    assert got[0] == (123.0, None) and got[1] == (19.0, None)
    assert got[2][1] == "missing terrain on land" and got[3][1] == "missing geoid on ocean"
    assert strict_elevation(merged.filter("k < 2")).count() == 2
    with pytest.raises(Exception, match="missing"):
        strict_elevation(merged).collect()
    empty = coverage_report(merged.filter("land")).filter("surface = 'ocean'").first()
    assert (empty.samples, empty.missing_percent) == (0, None)


@pytest.mark.parametrize("shape", ["spread", "constant", "lumpy", "single"])
def test_percentiles_equal_numpy(spark, shape):
    rng = np.random.default_rng(6)
    values = {"spread": rng.normal(0, 1e4, 501), "constant": np.full(9, 4.5), "lumpy": np.concatenate([np.full(300, 2.0), rng.random(40), [1e9]]), "single": np.array([7.0])}[shape]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    got = {r.p: r.value for r in exact_percentiles(df, F.col("v"), [0, 0.01, 0.5, 0.99, 1], [], bins=16).collect()}
    expected = np.percentile(values, [0, 1, 50, 99, 100])
    np.testing.assert_allclose([got[p] for p in (0, 0.01, 0.5, 0.99, 1)], expected, rtol=1e-12)
    assert exact_percentiles(df.limit(0), F.col("v"), [0.5], []).isEmpty()


@pytest.mark.parametrize("shape", ["outlier", "both ends", "powers", "infinite"])
def test_percentiles_cut_crowded_bins_again(spark, shape):
    """With few bins and a small limit, a bin that holds nearly all values is cut until it is small."""
    rng = np.random.default_rng(8)
    body = rng.normal(0, 1, 400)
    values = {"outlier": np.append(body, 1e300), "both ends": np.concatenate(([-1e12, 1e15], body)), "powers": 10.0 ** rng.uniform(-200, 200, 300), "infinite": np.append(body, np.inf)}[shape]
    df = spark.createDataFrame([("k", float(v)) for v in values] + [("other", 3.0), ("none", None)], "g string, v double")
    got = {(r.g, r.p): r.value for r in exact_percentiles(df, F.col("v"), [0.02, 0.5, 0.75], ["g"], bins=8, small=12).collect()}
    np.testing.assert_allclose([got["k", p] for p in (0.02, 0.5, 0.75)], np.percentile(values, [2, 50, 75]), rtol=1e-12)
    assert got["other", 0.5] == 3.0 and len(got) == 6


def test_footprints_beside_the_area_are_not_found(spark):
    """Ring and box by brute force over edges cut into many points, and by hand for touching and enclosing rings."""
    box = (0.0, 0.0, 4.0, 2.0)
    by_hand = {
        "beside": ([(-3, 1), (-1, 4), (1, 4.5), (-2, 6)], False),
        "tilted beside": ([(5, -1), (7, 1), (5, 3.9), (4.5, 2.4)], False),
        "corner of the box": ([(3, 3), (5, 1), (6, 4)], True),
        "touches": ([(4, 1), (6, 0), (6, 2)], True),
        "around": ([(-9, -9), (9, -9), (9, 9), (-9, 9)], True),
        "inside": ([(1, 0.5), (2, 0.5), (2, 1)], True),
        "around with a bay": ([(-9, -9), (9, -9), (9, 9), (-9, 9), (-9, 2.5), (5, 2.5), (5, -0.5), (-9, -0.5)], False),
        "box in the notch": ([(-1, -1), (-1, 5), (-2, 5), (-2, -2), (6, -2), (6, -1)], False),
    }
    rows = [(name, [{"x": float(x), "y": float(y)} for x, y in ring]) for name, (ring, _) in by_hand.items()] + [("empty", []), ("missing", None)]
    df = spark.createDataFrame(rows, "name string, ring array<struct<x: double, y: double>>")
    got = {r.name: r.meets for r in df.select("name", meets_box(F.col("ring"), *box).alias("meets")).collect()}
    assert got == {name: meets for name, (_, meets) in by_hand.items()} | {"empty": False, "missing": False}


def test_stored_catalogue_is_pruned_by_month_and_box(spark, tmp_path):
    rng = np.random.default_rng(2)
    rows = []
    for k in range(2000):
        x, y, r = float(rng.uniform(0, 140)), float(rng.uniform(-80, -60)), float(rng.uniform(0.5, 4))
        at = datetime(2021, 1, 1) + timedelta(hours=4 * k)
        rows.append((k, at, "Sentinel-1A", "EW", "GRD_HD", [{"x": x + r, "y": y}, {"x": x, "y": y + r}, {"x": x - r, "y": y}, {"x": x, "y": y - r}]))
    rows.append((9999, None, "Sentinel-1A", "EW", "GRD_HD", None))
    scenes = spark.createDataFrame(rows, "file_id int, start_time timestamp, platform string, beam_mode string, processing_level string, footprint array<struct<x: double, y: double>>")
    catalog.store_catalog(scenes, str(tmp_path / "c"))
    stored = catalog.stored_catalog(spark, str(tmp_path / "c"))
    assert stored.count() == 2001
    request = ((75.5, -69.2, 80.5, -67.3), "2021-03-10", "2021-10-05", ["EW"], ["GRD_HD"])
    found = catalog.search_catalog(stored, *request)
    ids = sorted(r.file_id for r in found.collect())
    def distance(k):
        ring = rows[k][5]
        x, y, r = ring[1]["x"], ring[0]["y"], ring[0]["x"] - ring[1]["x"]
        return (max(0, 75.5 - x, x - 80.5) + max(0, -69.2 - y, y + 67.3)) / r
    days = [k for k in range(2000) if datetime(2021, 3, 10) <= rows[k][1] < datetime(2021, 10, 6)]
    assert ids == [k for k in days if distance(k) <= 1] and ids
    assert ids == sorted(r.file_id for r in catalog.search_catalog(scenes, *request).collect())
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = catalog.search_catalog(stored, *request)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(east,75.5)" in plan.split("PushedFilters")[1] and "2021-03" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
