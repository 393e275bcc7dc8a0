"""Quality classification from positive and unlabelled texts.

A small network is trained on trusted positives (label 1) and unlabelled texts by the
non-negative unbiased risk: prior * loss(positives as 1) + max(0, loss(unlabelled as 0)
- prior * loss(positives as 0)). Inputs are figures of the whole text alone.

Defined cases: a null text counts as empty; an empty text is scored from its (zero)
figures; without any positive row every score is the prior (0.5 where unknown).
Repeated rows are scored alike; further columns are neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floe.llm.common import flat, held_out, sliced
from floe.llm.rolling import is_space, word_hashes, word_spans

_BYTE = np.arange(256)
#: groups of bytes whose shares are figures of a text
CLASSES = (
    (_BYTE >= 97) & (_BYTE <= 122),
    (_BYTE >= 65) & (_BYTE <= 90),
    (_BYTE >= 48) & (_BYTE <= 57),
    is_space(_BYTE),
    _BYTE >= 128,
    np.isin(_BYTE, list(b".,;:")),
    np.isin(_BYTE, list(b"!?")),
    np.isin(_BYTE, list(b"#%&*$@^~=+_")),
    np.isin(_BYTE, list(b"|<>{}[]\\/")),
    _BYTE == 10,
)
_CLASS_OF = np.full(256, len(CLASSES))
for _k, _c in reversed(list(enumerate(CLASSES))):
    _CLASS_OF[_c] = _k
N_FIGURES = len(CLASSES) + 8


def _per_text(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(owner, values, n)


def figures(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of figures per text: byte groups, word lengths, repetition of words, word pairs and lines."""
    n, size = len(offsets) - 1, np.maximum(1, np.diff(offsets))
    text = np.repeat(np.arange(n), np.diff(offsets))
    groups = np.bincount(text * (len(CLASSES) + 1) + _CLASS_OF[data], minlength=n * (len(CLASSES) + 1)).reshape(n, -1)
    out = np.zeros((n, N_FIGURES))
    out[:, : len(CLASSES)] = np.sqrt(groups[:, : len(CLASSES)] / size[:, None])
    brk = np.zeros(len(data), bool)  # texts never share a word
    brk[offsets[1:-1][offsets[1:-1] < len(data)]] = True
    starts, ends = word_spans(data)
    inner = np.flatnonzero(brk & ~is_space(data) if len(data) else brk)
    inner = inner[inner > 0]
    inner = inner[~is_space(data[inner - 1])]
    starts, ends = np.sort(np.concatenate((starts, inner))), np.sort(np.concatenate((ends, inner)))
    if not len(starts):
        return out
    hashes, owner = word_hashes(data, starts, ends), text[starts]
    words = np.maximum(1, np.bincount(owner, minlength=n))
    length = (ends - starts).astype(float)
    mean = _per_text(length, owner, n) / words

    def share_new(keys: np.ndarray, owner: np.ndarray, total: np.ndarray) -> np.ndarray:
        order = np.lexsort((keys, owner))
        k, o = keys[order], owner[order]
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (o[1:] != o[:-1])
        return np.bincount(o[new], minlength=n) / np.maximum(1, total)

    same = owner[1:] == owner[:-1]
    pairs = (hashes[:-1] * np.uint64(3) + hashes[1:])[same]
    twice = (hashes[1:] == hashes[:-1]) & same
    lines, line_of = _lines(data, offsets)
    k = len(CLASSES)
    out[:, k] = np.log1p(words) / 5
    out[:, k + 1] = mean / 10
    out[:, k + 2] = np.sqrt(np.maximum(0, _per_text(length**2, owner, n) / words - mean**2)) / 10
    out[:, k + 3] = share_new(hashes, owner, words)
    out[:, k + 4] = share_new(pairs, owner[1:][same], np.bincount(owner[1:][same], minlength=n))
    out[:, k + 5] = np.bincount(owner[1:][twice], minlength=n) / words
    out[:, k + 6] = share_new(lines, line_of, np.bincount(line_of, minlength=n))
    out[:, k + 7] = _per_text(np.isin(data[ends - 1], list(b"#%&*$|!")).astype(float), owner, n) / words
    return out


def _lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of every line."""
    cut = np.unique(np.concatenate((np.flatnonzero(data == 10) + 1, offsets[:-1], [0])))
    cut = cut[cut < len(data)]
    ends = np.append(cut[1:], len(data))
    return word_hashes(data, cut, ends), np.searchsorted(offsets, cut, "right") - 1


class Net:
    """Standardised figures, one hidden layer, a logistic output."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, hidden: int, seed: int):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        self.weights = [rng.normal(0, (1 / len(mean)) ** 0.5, (len(mean), hidden)), np.zeros(hidden), rng.normal(0, (1 / hidden) ** 0.5, (hidden, 1)), np.zeros(1)]

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b, c, d = self.weights
        h = np.tanh(x @ a + b)
        return h, (h @ c + d)[:, 0]

    def scores(self, figures: np.ndarray) -> np.ndarray:
        z = self.forward(np.clip((figures - self.mean) / self.scale, -8, 8))[1]
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def train(positive: np.ndarray, unlabelled: np.ndarray, prior: float, hidden: int = 16, steps: int = 1500, batch: int = 512, seed: int = 7) -> Net:
    """Minimise the non-negative risk by Adam; where its second part turns negative, that part is climbed instead."""
    net = Net(unlabelled.mean(0), unlabelled.std(0) + 0.02, hidden, seed)
    ready = lambda f: np.clip((f - net.mean) / net.scale, -8, 8)
    p_all, u_all = ready(positive), ready(unlabelled)
    rng = np.random.default_rng(seed)
    first, second = [0 * w for w in net.weights], [0 * w for w in net.weights]
    for step in range(1, steps + 1):
        p, u = p_all[rng.integers(0, len(p_all), batch)], u_all[rng.integers(0, len(u_all), batch)]
        x = np.concatenate((p, u))
        h, z = net.forward(x)
        s = 1 / (1 + np.exp(-np.clip(z, -60, 60)))
        as_zero = np.logaddexp(0, z)
        rest = as_zero[batch:].mean() - prior * as_zero[:batch].mean()
        dz = np.empty_like(z)
        if rest >= 0:
            dz[:batch] = prior * (s[:batch] - 1) - prior * s[:batch]
            dz[batch:] = s[batch:]
        else:
            dz[:batch] = prior * s[:batch]
            dz[batch:] = -s[batch:]
        dz /= batch
        a, b, c, d = net.weights
        dh = dz[:, None] * c[:, 0] * (1 - h**2)
        grads = [x.T @ dh + 1e-4 * a, dh.sum(0), h.T @ dz[:, None] + 1e-4 * c, np.array([dz.sum()])]
        rate = 0.01 * min(1, 2 * (1 - step / (steps + 1)))
        for k, g in enumerate(grads):
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            net.weights[k] = net.weights[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return net


def _figures_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        rows = figures(*flat(batch.column("text")))
        yield pa.record_batch({"label": batch.column("label"), "figures": pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), N_FIGURES).cast(pa.list_(pa.float64()))})


def fit(docs: DataFrame, labels: DataFrame, sample: int = 20_000) -> Net | float:
    """Train on at most about ``sample`` positives and ``sample`` unlabelled texts, chosen by hash of the id.

    The prior is the share of label 1 among the labelled training rows. Rows of the
    evaluation fold lend no label; their texts may stand among the unlabelled.
    """
    known = labels.select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("label")).filter(~held_out(F.col("id")) & F.col("label").isin(0, 1)).dropDuplicates(["id"])
    n = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    total = docs.count()
    prior = n.get(1, 0) / sum(n.values()) if n else 0.5
    if not n.get(1) or not total:
        return prior
    bucket = lambda c: F.pmod(F.xxhash64(c, F.lit("quality")), F.lit(1_000_000))
    trusted = known.filter((F.col("label") == 1) & (bucket("id") < 1_000_000 * sample / n[1]))
    chosen = docs.select("doc_id", "text").join(trusted, F.col("doc_id") == F.col("id"), "left_semi").select("text", F.lit(1).alias("label"))
    loose = docs.filter(bucket("doc_id") < 1_000_000 * sample / total).select("text", F.lit(0).alias("label"))
    rows = chosen.unionByName(loose).mapInArrow(_figures_of, "label int, figures array<double>").toPandas()
    x, y = np.array(rows["figures"].tolist()).reshape(-1, N_FIGURES), rows["label"].to_numpy()
    order = np.lexsort((*x.T, y))  # training must not depend on the order of arrival
    x, y = x[order], y[order]
    if not (y == 1).any() or not (y == 0).any():
        return prior
    return train(x[y == 1], x[y == 0], min(prior, 0.98))


def score(docs: DataFrame, model: Net | float) -> DataFrame:
    """doc_id and score (0 to 1, higher: good text likelier)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in sliced(batches):
            rows = figures(*flat(batch.column("text")))
            out = net.scores(rows) if isinstance(net, Net) else np.full(len(rows), net)
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "score": pa.array(out)})

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, score double")
