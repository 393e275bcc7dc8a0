"""NumPy kernel for one texture tile and its halo (runs inside a Spark task)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


class BoxSums:
    """Centred box sums of one array at any width up to ``2 * reach + 1``.

    One running table serves all widths, four look-ups each. Beyond the array either
    the edge cell repeats or nothing counts.
    """

    def __init__(self, values: np.ndarray, reach: int, edge: bool) -> None:
        n, m = values.shape
        self.shape, self.reach = (n, m), reach
        self.table = np.zeros((n + 2 * reach + 1, m + 2 * reach + 1))
        padded = np.pad(values, reach, mode="edge") if edge else np.pad(values, reach)
        np.cumsum(padded, axis=0, out=self.table[1:, 1:])
        np.cumsum(self.table[1:, 1:], axis=1, out=self.table[1:, 1:])

    def at(self, width: int, where: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
        """Sums around every cell, or around the cells of the given rows and columns only."""
        lo = self.reach - width // 2
        hi = lo + width
        n, m = self.shape
        t = self.table
        if where is not None:
            i, j = where[0][:, None], where[1][None, :]
            return t[i + hi, j + hi] - t[i + lo, j + hi] - t[i + hi, j + lo] + t[i + lo, j + lo]
        out = t[hi : hi + n, hi : hi + m] - t[lo : lo + n, hi : hi + m]
        out -= t[hi : hi + n, lo : lo + m]
        out += t[lo : lo + n, lo : lo + m]
        return out


class Masked:
    """Masked box means of arrays that share one pattern of missing cells."""

    def __init__(self, seen: np.ndarray, reach: int, edge: bool, min_fraction: float) -> None:
        self.seen, self.reach, self.edge, self.min_fraction = seen, reach, edge, min_fraction
        self.whole = edge and bool(seen.all())
        self.counts = None if self.whole else BoxSums(seen, reach, edge)

    def sums(self, values: np.ndarray) -> BoxSums:
        return BoxSums(values if self.whole else np.where(self.seen, values, 0.0), self.reach, self.edge)

    def mean(self, sums: BoxSums, width: int, where: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
        total = sums.at(width, where)
        if self.whole:
            total /= width * width
            return total
        count = np.rint(self.counts.at(width, where))
        enough = (count > 0) & (count >= self.min_fraction * width * width)
        np.divide(total, count, out=total, where=enough)
        total[~enough] = np.nan
        return total


def textures(a: np.ndarray, b: np.ndarray, widths: tuple[int, ...], min_fraction: float, where: tuple[np.ndarray, np.ndarray] | None = None) -> list[np.ndarray]:
    """Normalised local cross-product of two float arrays at each width; NaN is missing.

    With ``where`` (rows, columns) the last means are looked up for these cells only.
    Values are taken relative to their mean over the array, which changes no variance
    and no deviation but keeps the running tables small.
    """
    seen = [np.isfinite(v) for v in (a, b)]
    pick = (lambda v: v) if where is None else (lambda v: v[np.ix_(*where)])
    usable_pair = pick(seen[0] & seen[1])
    if not (seen[0] & seen[1]).any():
        return [np.full(usable_pair.shape, np.nan) for _ in widths]
    reach = max(widths) // 2
    masks, levels, plain, squared = [], [], [], []
    for values, known in zip((a, b), seen):
        level = values - values[known].mean()
        mask = Masked(known, reach, True, min_fraction)
        masks.append(mask)
        levels.append(level)
        plain.append(mask.sums(level))
        squared.append(mask.sums(level * level))
    out = []
    with np.errstate(invalid="ignore"):
        for width in widths:
            half = width // 2
            deviations, spread = [], 0.0
            for mask, level, first, second in zip(masks, levels, plain, squared):
                mean = mask.mean(first, width)
                deviations.append(level - mean)
                mean *= mean
                spread = spread + np.sqrt(np.maximum(mask.mean(second, width) - mean, 0))
            power = spread * spread / 4
            cross = deviations[0] * deviations[1]
            power_mask = Masked(np.isfinite(power), half, True, min_fraction)
            cross_mask = Masked(np.isfinite(cross), half, False, min_fraction)
            below = power_mask.mean(power_mask.sums(power), width, where)
            above = cross_mask.mean(cross_mask.sums(cross), width, where)
            usable = np.isfinite(above) & (below > 1e-12) & usable_pair
            out.append(np.divide(above, below, out=np.full(usable_pair.shape, np.nan), where=usable))
    return out


def _list_values(column: pa.ChunkedArray) -> list[np.ndarray]:
    """List cells as float64 arrays, NULL elements as NaN."""
    out = []
    for chunk in column.chunks:
        flat = chunk.values.to_numpy(zero_copy_only=False).astype(np.float64)
        offsets = chunk.offsets.to_numpy()
        out += [flat[lo:hi] for lo, hi in zip(offsets[:-1], offsets[1:])]
    return out


def tile_function(widths: tuple[int, ...], min_fraction: float, tile: int, precision: str):
    """Group function: one core tile plus its neighbour strips to texture bands of the core."""
    halo = 2 * (max(widths) // 2)
    stored = {"float": np.float32, "double": np.float64}[precision]

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        ty, tx = key[1].as_py(), key[2].as_py()
        height, width = table["height"][0].as_py(), table["width"][0].as_py()
        row0, col0 = ty * tile, tx * tile
        h, w = min(tile, height - row0), min(tile, width - col0)
        top, left = max(0, row0 - halo), max(0, col0 - halo)
        bottom, right = min(height, row0 + h + halo), min(width, col0 + w + halo)
        pair = [np.full((bottom - top, right - left), np.nan) for _ in range(2)]
        rows, cols = table["row0"].to_pylist(), table["col0"].to_pylist()
        heights, widths_in = table["h"].to_pylist(), table["w"].to_pylist()
        for image, name in zip(pair, ("a", "b")):
            for r, c, ph, pw, flat in zip(rows, cols, heights, widths_in, _list_values(table[name])):
                image[r - top : r - top + ph, c - left : c - left + pw] = flat.reshape(ph, pw)
        core = (slice(row0 - top, row0 - top + h), slice(col0 - left, col0 - left + w))
        bands = []
        for band in textures(pair[0], pair[1], widths, min_fraction):
            flat = band[core].astype(stored).ravel()
            values = pa.array(flat, mask=np.isnan(flat))
            bands.append(pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), values))
        ints = lambda v, t: pa.array([v], t)
        columns = {
            "scene_id": pa.array([key[0].as_py()], key[0].type),
            "ty": ints(ty, pa.int64()),
            "tx": ints(tx, pa.int64()),
            "row0": ints(row0, pa.int64()),
            "col0": ints(col0, pa.int64()),
            "h": ints(h, pa.int32()),
            "w": ints(w, pa.int32()),
        }
        columns.update({f"t{k}": band for k, band in enumerate(bands, 1)})
        return pa.table(columns)

    return run


def _masked(image: np.ndarray, spans: list[dict], top: int, left: int) -> None:
    """Cells of row spans turn missing, in place."""
    for span in spans:
        row, low, high = span["row"] - top, max(0, span["lo"] - left), span["hi"] - left + 1
        if 0 <= row < image.shape[0] and high > low:
            image[row, low:high] = np.nan


def sample_positions(low: int, high: int, extent: int, factor: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells of a decimated axis whose nearest source cell lies in [low, high), and these source cells."""
    many = -(-extent // factor)
    cell = np.arange(max(0, low * many // extent - 1), min(many, high * many // extent + 2))
    source = (2 * cell + 1) * extent // (2 * many)
    inside = (source >= low) & (source < high)
    return cell[inside], source[inside]


def sampled_function(widths: tuple[int, ...], min_fraction: float, tile: int, factor: int, units: str):
    """Group function: one core tile, its neighbour strips and mask spans to texture at decimated cells only."""
    halo = 2 * (max(widths) // 2)

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        ty, tx = key[1].as_py(), key[2].as_py()
        height, width = table["height"][0].as_py(), table["width"][0].as_py()
        row0, col0 = ty * tile, tx * tile
        h, w = min(tile, height - row0), min(tile, width - col0)
        top, left = max(0, row0 - halo), max(0, col0 - halo)
        bottom, right = min(height, row0 + h + halo), min(width, col0 + w + halo)
        pair = [np.full((bottom - top, right - left), np.nan) for _ in range(2)]
        places = list(zip(*(table[c].to_pylist() for c in ("row0", "col0", "h", "w"))))
        for image, name in zip(pair, ("a", "b")):
            for (r, c, ph, pw), flat in zip(places, _list_values(table[name])):
                image[r - top : r - top + ph, c - left : c - left + pw] = flat.reshape(ph, pw)
            if units == "linear_power":
                with np.errstate(divide="ignore", invalid="ignore"):
                    image[:] = np.where(image > 0, 10 * np.log10(image), np.nan)
            for spans in table["spans"].to_pylist():
                _masked(image, spans or [], top, left)
        (rows, from_rows), (cols, from_cols) = sample_positions(row0, row0 + h, height, factor), sample_positions(col0, col0 + w, width, factor)
        flat = [band.ravel() for band in textures(*pair, widths, min_fraction, (from_rows - top, from_cols - left))]
        one = lambda values, mask=None: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, mask=mask))
        columns = {"scene_id": pa.array([key[0].as_py()], key[0].type), "row": one(np.repeat(rows, len(cols))), "col": one(np.tile(cols, len(rows)))}
        columns.update({f"t{k}": one(band, np.isnan(band)) for k, band in enumerate(flat, 1)})
        return pa.table(columns)

    return run
