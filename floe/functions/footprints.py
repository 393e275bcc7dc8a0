"""Footprint geometry in Arrow batches: validity, orientation, convex clipping.

Footprints have a handful of corners and come in their millions, so each batch is
one set of NumPy arrays (rows x corners); nothing loops over rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

_POINT = pa.struct([("x", pa.float64()), ("y", pa.float64())])

# ``inside`` is a packed ring, ``convex`` and the box ``x0 .. y1`` are of it
JUDGED = T.StructType(
    [
        T.StructField("simple", T.BooleanType()),
        T.StructField("convex", T.BooleanType()),
        T.StructField("inside", T.BinaryType()),
        *[T.StructField(name, T.DoubleType()) for name in ("x0", "y0", "x1", "y1", "share")],
    ]
)


def corners(rings: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Rings as a (rows, corners, 2) array, short rings filled with their last corner, and the counts."""
    counts = rings.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = rings.flatten()
    points = np.stack([flat.field(k).to_numpy(zero_copy_only=False) for k in (0, 1)], axis=-1)
    return _filled(points, counts), counts


def opened(points: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Filled rings without a repeated closing corner."""
    closed = np.flatnonzero((counts > 1) & (points[:, 0] == points[:, -1]).all(axis=1))
    if len(closed):
        points, counts = points.copy(), counts.copy()
        counts[closed] -= 1
        index = np.minimum(np.arange(points.shape[1]), counts[closed, None] - 1)
        points[closed] = points[closed[:, None], index]
    return points, counts


def _filled(points: np.ndarray, counts: np.ndarray) -> np.ndarray:
    out = np.zeros((len(counts), max(int(counts.max(initial=0)), 1), 2))
    starts = np.cumsum(counts) - counts
    index = starts[:, None] + np.minimum(np.arange(out.shape[1]), np.maximum(counts - 1, 0)[:, None])
    filled = counts > 0
    out[filled] = points[index[filled]]
    return out


def pack(points: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Rings as bytes of their coordinates, with corners that repeat the one before left out; the same rings as arrays, and the counts.

    Packed rings travel from task to task as they are, without a value for each coordinate.
    """
    kept = (points != np.roll(points, 1, axis=1)).any(axis=-1)
    kept[:, 0] |= ~kept.any(axis=1)
    counts = kept.sum(axis=1)
    offsets = np.concatenate([[0], np.cumsum(counts)])
    flat = np.ascontiguousarray(points[kept], dtype="<f8")
    packed = pa.Array.from_buffers(pa.binary(), len(points), [None, pa.py_buffer((16 * offsets).astype(np.int32)), pa.py_buffer(flat)])
    return packed, _filled(flat, counts), counts


def unpack(packed: pa.Array) -> np.ndarray:
    """Packed rings as a (rows, corners, 2) array, short rings filled with their last corner."""
    buffers = packed.buffers()
    kind = np.int64 if pa.types.is_large_binary(packed.type) else np.int32
    offsets = np.frombuffer(buffers[1], kind)[packed.offset : packed.offset + len(packed) + 1].astype(np.int64) // 16
    flat = np.frombuffer(buffers[2], "<f8").reshape(-1, 2)[offsets[0] : offsets[-1]] if len(packed) else np.zeros((0, 2))
    return _filled(flat, np.diff(offsets))


def cross(o: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p[..., 0] - o[..., 0]) * (q[..., 1] - o[..., 1]) - (p[..., 1] - o[..., 1]) * (q[..., 0] - o[..., 0])


def signed_area(points: np.ndarray) -> np.ndarray:
    """Shoelace about the first corner; repeated corners add nothing."""
    return cross(points[:, :1], points, np.roll(points, -1, axis=1)).sum(axis=1) / 2


def _ahead(points: np.ndarray, counts: np.ndarray, steps: int) -> np.ndarray:
    """Corner ``steps`` further round each ring."""
    index = (np.arange(points.shape[1]) + steps) % np.maximum(counts, 1)[:, None]
    return np.take_along_axis(points, index[..., None], axis=1)


def is_simple(points: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """At least three corners, some area, and no edge crossing another."""
    x, y = np.ascontiguousarray(points.T)
    after = np.roll(np.arange(len(x)), -1)
    parted = []  # by edge: whether its line parts the ends of each edge
    for k, n in enumerate(after):
        side = (x[n] - x[k]) * (y - y[k]) - (y[n] - y[k]) * (x - x[k])
        parted.append(side * side[after] < 0)
    parted = np.stack(parted)
    crossing = (parted & parted.swapaxes(0, 1)).any(axis=(0, 1))
    return (counts >= 3) & (signed_area(points) != 0) & ~crossing


def is_convex(points: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All turns to one side and a single revolution."""
    real = np.arange(points.shape[1]) < counts[:, None]
    first, second = _ahead(points, counts, 1), _ahead(points, counts, 2)
    turn = np.where(real, cross(points, first, second), 0)
    along = ((first - points) * (second - first)).sum(axis=-1)
    revolution = np.abs(np.where(real, np.arctan2(turn, along), 0).sum(axis=1))
    return ((turn >= 0).all(axis=1) | (turn <= 0).all(axis=1)) & (np.abs(revolution - 2 * np.pi) < 1e-6)


def ccw(points: np.ndarray) -> np.ndarray:
    """Counter-clockwise; fill corners at the tail keep working reversed (they repeat a corner)."""
    return np.where((signed_area(points) < 0)[:, None, None], points[:, ::-1], points)


def clip(subject: np.ndarray, clipper: np.ndarray) -> np.ndarray:
    """Subjects inside convex counter-clockwise clippers, row by row, one half plane after another.

    A ring with nothing left becomes a single repeated point.
    """
    for k in range(clipper.shape[1]):
        start, stop = clipper[:, k, None], clipper[:, (k + 1) % clipper.shape[1], None]
        side = cross(start, stop, subject)
        cut = np.flatnonzero(~(side >= 0).all(axis=1))
        if len(cut):
            part, counts = _cut(subject[cut], side[cut])
            part[counts == 0] = start[cut[counts == 0]]
            if len(cut) < len(subject):  # the others stay as they are
                width = np.arange(max(part.shape[1], subject.shape[1]))
                whole = subject[:, np.minimum(width, subject.shape[1] - 1)]
                whole[cut] = part[:, np.minimum(width, part.shape[1] - 1)]
                part = whole
            subject = part
    return subject


def _cut(points: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The part of each ring where ``side`` is not negative, and its number of corners."""
    keep = side >= 0
    keep_after = np.roll(keep, -1, axis=1)
    # along each edge: the crossing point if any, then the end corner if kept
    wanted = np.stack([keep != keep_after, keep_after], axis=2)
    offered = np.repeat(np.roll(points, -1, axis=1)[:, :, None], 2, axis=2)
    row, corner = np.nonzero(wanted[..., 0])
    after = (corner + 1) % side.shape[1]
    share = side[row, corner] / (side[row, corner] - side[row, after])
    offered[row, corner, 0] = points[row, corner] + share[:, None] * (points[row, after] - points[row, corner])
    counts = wanted.sum(axis=(1, 2))
    return _filled(offered[wanted], counts), counts


def _frame(box: tuple[tuple[float, float], ...], rows: int) -> np.ndarray:
    return np.broadcast_to(np.asarray(box, dtype=float), (rows, len(box), 2))


def judge(frame: tuple[tuple[float, float], ...]):
    """UDF over footprints, closed or not: validity, and the counter-clockwise part inside a convex frame."""

    def run(rings: pa.Array) -> pa.Array:
        points, counts = opened(*corners(rings))
        simple = is_simple(points, counts)
        box = ccw(_frame(frame, len(points)))
        packed, inside, kept = pack(clip(ccw(points), box))
        share = np.abs(signed_area(inside)) / np.abs(signed_area(box))
        bounds = np.concatenate([inside.min(axis=1), inside.max(axis=1)], axis=1)
        columns = [pa.array(simple), pa.array(is_convex(inside, kept)), packed, *[pa.array(np.ascontiguousarray(bounds[:, k])) for k in range(4)], pa.array(share)]
        return pa.StructArray.from_arrays(columns, names=JUDGED.names)

    return F.arrow_udf(run, JUDGED)


def shared_area(subject: np.ndarray, clipper: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Common area of counter-clockwise simple rings, row by row; either may be concave."""
    return _shared_area(subject, np.zeros(len(subject), bool), clipper, is_convex(clipper, counts))


def _shared_area(first: np.ndarray, first_convex: np.ndarray, second: np.ndarray, second_convex: np.ndarray) -> np.ndarray:
    """Common area; whichever ring is convex clips the other."""
    out = np.zeros(len(first))
    turned = first_convex & ~second_convex
    for subject, clipper, rows in ((first, second, second_convex), (second, first, turned)):
        if rows.any():
            out[rows] = signed_area(clip(subject[rows], clipper[rows]))
    rest = np.flatnonzero(~second_convex & ~turned)
    step = max(1, 200_000 // (first.shape[1] * second.shape[1]))
    for at in range(0, len(rest), step):
        rows = rest[at : at + step]
        out[rows] = _edgewise_area(first[rows], second[rows])
    return np.maximum(out, 0.0)


def _edgewise_area(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Common area of counter-clockwise simple rings of any shape, without clipping.

    A ring is the sum of the regions below its edges, edges to the west counting positive and edges
    to the east negative; so what two rings share is the sum, over pairs of edges, of what lies
    below both: the lower of two lines over the stretch of x that the edges have in common.
    """
    origin = first[:, :1]
    p, q = ((v - origin)[:, :, None] for v in (first, np.roll(first, -1, axis=1)))
    r, s = ((v - origin)[:, None] for v in (second, np.roll(second, -1, axis=1)))
    (px, py), (qx, qy), (rx, ry), (sx, sy) = ((v[..., 0], v[..., 1]) for v in (p, q, r, s))
    low = np.maximum(np.minimum(px, qx), np.minimum(rx, sx))
    high = np.minimum(np.maximum(px, qx), np.maximum(rx, sx))
    wide, long = qx - px, sx - rx
    some = (high > low) & (wide != 0) & (long != 0)
    tilt, slant = (qy - py) / np.where(wide != 0, wide, 1), (sy - ry) / np.where(long != 0, long, 1)
    # the height of either line at both ends, and how far the first is above the second there
    a0, a1 = py + (low - px) * tilt, py + (high - px) * tilt
    b0, b1 = ry + (low - rx) * slant, ry + (high - rx) * slant
    d0, d1 = a0 - b0, a1 - b1
    total = np.abs(d0) + np.abs(d1)
    apart = np.where(d0 * d1 < 0, (d0 * d0 + d1 * d1) / np.where(total > 0, total, 1), total)
    below = np.where(some, (a0 + a1 + b0 + b1 - apart) / 4 * (high - low), 0)
    return (np.sign(wide) * np.sign(long) * below).sum(axis=(1, 2))


def common_area():
    """UDF: area common to two packed simple counter-clockwise rings, each with a flag whether it is convex."""

    def run(first: pa.Array, first_convex: pa.Array, second: pa.Array, second_convex: pa.Array) -> pa.Array:
        flags = (c.to_numpy(zero_copy_only=False).astype(bool) for c in (first_convex, second_convex))
        return pa.array(_shared_area(unpack(first), next(flags), unpack(second), next(flags)))

    return F.arrow_udf(run, T.DoubleType())
