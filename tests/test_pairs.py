from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from floe.operators.pairs import compatible_pairs, rejected_scenes, select_pairs
from floe.schema import PairRules

AOI = (75.5, -69.2, 80.5, -67.3)
BOX = [(75.0, -70.0), (81.0, -70.0), (81.0, -66.0), (75.0, -66.0)]
COLUMNS = (
    "file_id string, start_time timestamp, path_number bigint, flight_direction string, beam_mode string, "
    "polarization string, footprint array<struct<x:double,y:double>>"
)
START = datetime(2021, 10, 10)


def scene(name, days=0, path=7, direction="ASCENDING", mode="EW", pol="HH+HV", ring=BOX):
    return (name, START + timedelta(days=days), path, direction, mode, pol, ring)


def pairs(spark, *rows, rules=PairRules(), aoi=AOI):
    return compatible_pairs(spark.createDataFrame(list(rows), COLUMNS), aoi, rules)


def test_one_pair_whatever_the_order(spark):
    found = pairs(spark, scene("late", 12), scene("early")).collect()
    assert len(found) == 1
    p = found[0]
    assert (p.first_id, p.second_id, p.baseline_days) == ("early", "late", 12.0)
    assert p.common_aoi_fraction == pytest.approx(1.0)
    assert p.pair_id.startswith("20211010T000000_20211022T000000_") and len(p.pair_id) == 40


@pytest.mark.parametrize(
    "change",
    [
        {"path": 8},
        {"path": None},
        {"direction": "DESCENDING"},
        {"mode": "IW"},
        {"pol": "VV+VH"},
        {"days": 2.999},
        {"days": 24.001},
        {"ring": [(75.0, -70.0), (76.0, -70.0), (76.0, -69.0), (75.0, -69.0)]},
        {"ring": [(75.0, -70.0), (81.0, -66.0), (81.0, -70.0), (75.0, -66.0)]},
    ],
)
def test_each_mismatch_kills_the_pair(spark, change):
    other = scene("b", **{"days": 12, **change})
    assert pairs(spark, scene("a"), other).isEmpty()


def test_gap_limits_are_inclusive(spark):
    assert pairs(spark, scene("a"), scene("b", 3), scene("c", 24)).select("baseline_days").orderBy("baseline_days").collect() == [(3.0,), (21.0,), (24.0,)]


def test_concave_footprints_pair_and_none_ends_the_job(spark):
    ell = [(75.5, -69.2), (80.5, -69.2), (80.5, -68.25), (78.0, -68.25), (78.0, -67.3), (75.5, -67.3)]
    bow = [(75.5, -69.2), (80.5, -67.3), (80.5, -69.2), (75.5, -67.3), (75.5, -68.0)]
    rows = [scene("a", ring=ell), scene("b", 12, ring=ell), scene("c", 12, ring=bow)]
    found = pairs(spark, *rows).collect()
    assert [(r.first_id, r.second_id) for r in found] == [("a", "b")]
    assert found[0].common_aoi_fraction == pytest.approx(0.75, abs=0.02)
    rows += [scene("d", pol="VV"), scene("e", ring=[(75.0, -70.0), (76.0, -70.0), (76.0, -69.0)]), scene("f", path=None)]
    rejects = {r.file_id: r.reason for r in rejected_scenes(spark.createDataFrame(rows, COLUMNS), AOI, PairRules()).collect()}
    assert rejects == {"c": "invalid footprint", "d": "incomplete or other polarisation", "e": "too little of the area", "f": "incomplete or other polarisation"}


def test_shared_area_of_concave_rings_against_sample_points():
    import numpy as np

    from floe.functions.footprints import ccw, shared_area

    rng = np.random.default_rng(6)

    def star(n):
        angle = np.sort(rng.uniform(0, 2 * np.pi, n))
        radius = rng.uniform(0.6, 3.0, n)
        return np.stack([radius * np.cos(angle), radius * np.sin(angle)], 1) + rng.normal(0, 0.5, 2)

    first, second = (np.stack([star(9) for _ in range(30)]) for _ in range(2))
    got = shared_area(ccw(first), ccw(second), np.full(30, 9))
    xs, ys = np.meshgrid(np.arange(-5, 5, 0.02), np.arange(-5, 5, 0.02))

    def inside(ring):
        odd = np.zeros(xs.shape, bool)
        for (x1, y1), (x2, y2) in zip(ring, np.roll(ring, -1, 0)):
            if y1 != y2:
                odd ^= ((y1 > ys) != (y2 > ys)) & (xs < x1 + (ys - y1) * (x2 - x1) / (y2 - y1))
        return odd

    for k in range(30):
        assert got[k] == pytest.approx((inside(first[k]) & inside(second[k])).sum() * 0.0004, abs=0.08)


def test_hot_orbit_key_gives_all_pairs(spark):
    rows = [scene(f"s{k:03d}", k / 4) for k in range(240)]
    times = [k / 4 for k in range(240)]
    expected = sum(1 for i, t in enumerate(times) for u in times[i + 1 :] if 3 <= u - t <= 24)
    assert pairs(spark, *rows).count() == expected


def test_slice(spark):
    found = pairs(spark, *[scene(f"s{k}", 6 * k) for k in range(4)])
    whole = [r.pair_id for r in found.orderBy("second_time", "baseline_days", "pair_id").collect()]
    assert [r.pair_id for r in select_pairs(found, 1, 2).collect()] == whole[1:3]


def test_rules_are_checked():
    for bad in ({"min_days": 0}, {"min_days": 30}, {"min_overlap": 0}, {"min_overlap": 1.5}, {"polarization": "HV"}):
        with pytest.raises(ValueError):
            PairRules(**bad)


def test_common_area_against_sample_points(spark):
    """Common area of skewed quadrilaterals against counting fine sample points."""
    import numpy as np
    import pyarrow as pa

    from floe.functions import footprints

    rng = np.random.default_rng(5)
    quads = np.array([[0, 0], [4, 0.5], [4.5, 4], [-0.5, 3.5]])
    first = [quads + rng.normal(0, 0.3, 2) for _ in range(40)]
    second = [quads[::-1] + rng.normal(0, 2, 2) for _ in range(40)]
    ring = lambda q: [{"x": float(x), "y": float(y)} for x, y in q]
    kind = pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))
    load = lambda qs: footprints.ccw(footprints.corners(pa.array([ring(q) for q in qs], kind))[0])
    got = np.abs(footprints.signed_area(footprints.clip(load(first), load(second))))
    xs, ys = np.meshgrid(np.arange(-8, 12, 0.02), np.arange(-8, 12, 0.02))

    def inside(q):
        sides = [(q[(k + 1) % 4][0] - q[k][0]) * (ys - q[k][1]) - (q[(k + 1) % 4][1] - q[k][1]) * (xs - q[k][0]) for k in range(4)]
        return np.logical_and.reduce([s >= 0 for s in sides]) | np.logical_and.reduce([s <= 0 for s in sides])

    for k in range(40):
        assert got[k] == pytest.approx((inside(first[k]) & inside(second[k])).sum() * 0.0004, abs=0.15)
