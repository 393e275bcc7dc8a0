"""Kernel classifier of segments: least squares in the space of Gaussian kernel features, one decision for each pair of classes.

The kernel is exp(-gamma * squared distance) of mean colours. A set of landmark colours, ``landmarks`` at
most, spans the space that decisions live in (Nystroem): with K the kernel among the landmarks, a colour's features
are its kernels with them times the inverse root of K, so that inner products of features are kernels again. Where
the training table has no more different colours than that, this is the exact kernel machine; else the landmarks
are an even draw by hash. Training is one pass: squared loss needs only sums of products of features, which partitions
add up (landmarks squared numbers a class); a margin loss would need a pass over the table for each of its steps.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floe.operators.classify import FEATURE_COLUMNS
from floe.schema import TRAIN_CODES


@dataclass(frozen=True)
class KernelModel:
    """A decision for each pair of classes is ``features @ weights + intercept``, positive for the first of the two."""

    gamma: float
    landmarks: np.ndarray
    root: np.ndarray
    classes: tuple[int, ...]
    weights: np.ndarray
    intercepts: np.ndarray

    def decisions(self, colours: np.ndarray) -> np.ndarray:
        return kernel_features(colours, self.landmarks, self.root, self.gamma) @ self.weights.T + self.intercepts

    def predict(self, colours: np.ndarray) -> np.ndarray:
        """The class that wins most pairs; ties go to the smaller code."""
        first = self.decisions(colours) > 0
        votes = np.zeros((len(colours), len(self.classes)), np.int64)
        for k, (a, b) in enumerate(combinations(range(len(self.classes)), 2)):
            votes[:, a] += first[:, k]
            votes[:, b] += ~first[:, k]
        return np.array(self.classes)[votes.argmax(1)]


def kernel_features(colours: np.ndarray, landmarks: np.ndarray, root: np.ndarray, gamma: float) -> np.ndarray:
    square = (colours**2).sum(1)[:, None] + (landmarks**2).sum(1) - 2 * colours @ landmarks.T
    return np.exp(-gamma * np.maximum(square, 0)) @ root


def _inverse_root(kernel: np.ndarray) -> np.ndarray:
    """Inverse square root; directions that hold nothing but rounding are left out."""
    values, vectors = np.linalg.eigh(kernel)
    kept = values > values.max() * 1e-10
    return vectors[:, kept] / np.sqrt(values[kept])


def _complete(rows: DataFrame) -> DataFrame:
    good = F.lit(True)
    for name in FEATURE_COLUMNS:
        value = F.col(name).cast("double")
        good = good & value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))
    return rows.filter(good)


def fit_kernel(rows: DataFrame, penalty: float = 1.0, gamma: float | None = None, landmarks: int = 200) -> KernelModel:
    """Train on rows with ``r, g, b, label``; rows of other classes or with a missing colour take no part.

    ``gamma`` is, if not given, one by the number of colours times the variance of all their values. ``penalty`` is the
    weight of the loss against the length of the weights. Fewer than two classes are an error.
    """
    colours = [F.col(c).cast("double").alias(c) for c in FEATURE_COLUMNS]
    used = _complete(rows.filter(F.col("label").isin(*TRAIN_CODES))).select(*colours, F.col("label").cast("int").alias("label"))
    sums = [F.sum(F.col(c)).alias(f"s_{c}") for c in FEATURE_COLUMNS] + [F.sum(F.col(c) * F.col(c)).alias(f"q_{c}") for c in FEATURE_COLUMNS]
    facts = used.groupBy("label").agg(F.count("*").alias("n"), *sums).collect()  # a row a class, three at most
    counts = {f["label"]: f["n"] for f in facts}
    if len(counts) < 2:
        raise ValueError("at least two labelled classes are required")
    if gamma is None:
        values = len(FEATURE_COLUMNS) * sum(counts.values())
        mean, square = (sum(f[f"{part}_{c}"] for f in facts for c in FEATURE_COLUMNS) / values for part in "sq")
        spread = square - mean * mean
        gamma = 1 / (len(FEATURE_COLUMNS) * spread) if spread > 0 else 1.0

    drawn = used.select(*FEATURE_COLUMNS).distinct().orderBy(F.xxhash64(F.lit(11), *FEATURE_COLUMNS), *FEATURE_COLUMNS).limit(landmarks).collect()
    marks = np.array([tuple(m) for m in drawn])
    root = _inverse_root(kernel_features(marks, marks, np.eye(len(marks)), gamma))

    def products(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for frame in frames:
            labels = frame["label"].to_numpy()
            for label in np.unique(labels):
                part = frame.loc[labels == label, list(FEATURE_COLUMNS)].to_numpy(float)
                wide = np.column_stack((kernel_features(part, marks, root, gamma), np.ones(len(part))))
                total[label] = total.get(label, 0) + wide.T @ wide
        for label, matrix in total.items():
            yield pd.DataFrame({"label": int(label), "line": np.arange(len(matrix)), "v": list(matrix)})

    width = root.shape[1] + 1
    added = used.mapInPandas(products, "label int, line int, v array<double>").groupBy("label", "line")
    matrices = {label: np.zeros((width, width)) for label in counts}
    for row in added.agg(F.array(*[F.sum(F.get("v", F.lit(k))) for k in range(width)]).alias("v")).collect():  # width lines a class
        matrices[row["label"]][row["line"]] = row["v"]
    classes, solved = tuple(sorted(counts)), []
    shrink = np.diag([1 / penalty] * (width - 1) + [0.0])  # the intercept is free
    for a, b in combinations(classes, 2):
        solved.append(np.linalg.solve(matrices[a] + matrices[b] + shrink, matrices[a][-1] - matrices[b][-1]))
    weights, intercepts = np.array(solved)[:, :-1], np.array(solved)[:, -1]
    return KernelModel(float(gamma), marks, root, classes, weights, intercepts)


def classify_kernel(rows: DataFrame, model: KernelModel, out: str = "predicted") -> DataFrame:
    """Predicted class of every row; null where a colour is missing or not finite."""

    @F.pandas_udf("smallint")
    def predicted(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for channels in batches:
            colours = np.column_stack([c.to_numpy(float, na_value=np.nan) for c in channels])
            sound = np.isfinite(colours).all(1)
            found = pd.Series([None] * len(colours), dtype="Int16")
            if sound.any():
                found[sound] = model.predict(colours[sound]).astype(np.int16)
            yield found

    return rows.withColumn(out, predicted(*[F.col(c).cast("double") for c in FEATURE_COLUMNS]))


def assess_kernel(rows: DataFrame, held_out: list, fold: str = "fold", **options) -> DataFrame:
    """Predictions (``pred``) for the named groups, each by a model of all other groups.

    ``held_out`` is the caller's list of sites, a handful. Rows without a group train every model and are not assessed.
    """
    parts = []
    for group in held_out:
        model = fit_kernel(rows.filter(~F.col(fold).eqNullSafe(F.lit(group))), **options)
        parts.append(classify_kernel(rows.filter(F.col(fold) == group), model, "pred"))
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged
