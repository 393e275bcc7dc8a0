"""The kernel classifier against a brute-force dual solution, and its edge cases."""

import numpy as np
import pytest

from floe.operators.classify import classify_nearest, centroids
from floe.operators.kernel import assess_kernel, classify_kernel, fit_kernel

SCHEMA = "r double, g double, b double, label int, fold string"


def ringed(rng, n):
    """Class 0 in the middle, 2 on a ring about it, 3 above the middle."""
    label = rng.choice([0, 2, 3], n)
    angle, part = rng.uniform(0, 2 * np.pi, n), rng.uniform(0, 1, n)
    radius = np.where(label == 2, 80 + 30 * part, 30 * part)
    b = np.where(label == 3, 180.0, 30.0) + rng.uniform(0, 40, n)
    colours = np.column_stack((128 + radius * np.cos(angle), 128 + radius * np.sin(angle), b)).round(2)
    return colours, label


def table(spark, colours, label):
    rows = [(*map(float, c), int(k), "ab"[i % 2]) for i, (c, k) in enumerate(zip(colours, label))]
    return spark.createDataFrame(rows, SCHEMA)


def dual(kernel, y, c=1.0):
    """Multipliers and intercept of the least-squares kernel machine, from its full dual system."""
    n = len(y)
    system = np.block([[kernel + np.eye(n) / c, np.ones((n, 1))], [np.ones((1, n)), np.zeros((1, 1))]])
    solved = np.linalg.solve(system, np.append(y, 0))
    return solved[:-1], solved[-1]


def test_decisions_equal_the_dual_solution(spark):
    rng = np.random.default_rng(3)
    colours, label = ringed(rng, 90)
    label[rng.random(90) < 0.1] = 2  # some in the wrong place
    model = fit_kernel(table(spark, colours, label), landmarks=90)
    assert model.gamma == pytest.approx(1 / (3 * colours.var()))
    kernel = lambda x, z: np.exp(-model.gamma * ((x[:, None] - z) ** 2).sum(2))
    probes = rng.uniform(0, 255, (400, 3))
    got = model.decisions(probes)
    for k, (first, second) in enumerate([(0, 2), (0, 3), (2, 3)]):
        pair = (label == first) | (label == second)
        x, y = colours[pair], np.where(label[pair] == first, 1.0, -1.0)
        a, intercept = dual(kernel(x, x), y)
        want = kernel(probes, x) @ a + intercept
        assert np.abs(got[:, k] - want).max() < 1e-4


def test_separates_what_centres_cannot(spark):
    train, test = (table(spark, *ringed(np.random.default_rng(k), 300)) for k in (1, 2))
    right = lambda df: df.filter("predicted = label").count()
    assert right(classify_kernel(test, fit_kernel(train, landmarks=60))) == 300
    assert right(classify_nearest(test, centroids(train))) < 280
    held = assess_kernel(train, ["a", "b"], landmarks=60)
    assert held.count() == 300 and held.filter("pred = label").count() >= 298


def test_missing_foreign_and_single_classes(spark):
    colours, label = ringed(np.random.default_rng(4), 60)
    rows = table(spark, colours, label)
    spoiled = rows.union(spark.createDataFrame([(None, 1.0, 1.0, 0, "a"), (float("nan"), 1.0, 1.0, 2, "a"), (9.0, 9.0, 9.0, 1, "a"), (9.0, 9.0, 9.0, None, None)], SCHEMA))
    clean, other = fit_kernel(rows, landmarks=60), fit_kernel(spoiled, landmarks=60)
    assert clean.gamma == pytest.approx(other.gamma) and clean.classes == other.classes == (0, 2, 3)
    found = classify_kernel(spoiled, clean).collect()
    assert [f.predicted is None for f in found if f.r is None or f.r != f.r] == [True, True] and len(found) == 64
    assert all(f.predicted in (0, 2, 3) for f in found if f.r is not None and f.r == f.r)
    assert classify_kernel(rows.limit(0), clean).count() == 0
    assert classify_kernel(rows.repartition(3), fit_kernel(rows.union(rows), landmarks=60)).filter("predicted = label").count() == 60
    with pytest.raises(ValueError, match="two labelled classes"):
        fit_kernel(rows.filter("label = 0"))
    with pytest.raises(ValueError, match="two labelled classes"):
        fit_kernel(rows.limit(0))
