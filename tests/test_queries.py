"""Registered queries against their SQL on the smallest given tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
CHECKED = (
    "s1_scene_catalog p15_cell_area j2_polar_overlap j3_orbit_coverage j4_polygon_mask j19_regrid_bilinear a5_change_metrics "
    "a12_elevation_percentiles w3_texture_tiles g1_acquisition_groups g2_logo_predictions t1_weekly_series b6_validate_outline b8_season_reports"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def test_registry_is_consistent():
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries)
    assert len(queries) > 100
    without = {name for name in set(queries) - set(oracles) if not name.startswith("op") and name != "pipeline"}
    assert without <= {"g3_forest_classifier", "g3_forest_site_holdout", "b2_pair_product"}


def plain(value):
    if value is None or isinstance(value, (bool, str)):
        return value
    if isinstance(value, (int, float)):
        assert not (isinstance(value, float) and math.isnan(value))
        return float(value) + 0.0
    return str(value)


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    key = lambda row: tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=key)


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cursor = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted_rows(df.columns, df.collect()) == sorted_rows(columns, cursor.fetchall())


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 1
