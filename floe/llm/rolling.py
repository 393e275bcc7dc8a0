"""Rolling hashes and content-chosen anchors over runs of symbols, in NumPy.

All sums wrap modulo 2**64. Equal runs of symbols always get equal hashes.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
_STEP = U64(0x9E3779B97F4A7C15)
_BASE = 0xD1342543DE82EF95  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = np.ones(1, U64)
_inverses = np.ones(1, U64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


#: what stands for each byte value in a polynomial
BYTE_VALUES = mix(np.arange(1, 257, dtype=U64) * _STEP)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of each."""
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, 2 * len(_powers))
        base, back = np.full(size, _BASE, U64), np.full(size, _INVERSE, U64)
        base[0] = back[0] = 1
        _powers, _inverses = np.multiply.accumulate(base), np.multiply.accumulate(back)
    return _powers[:n], _inverses[:n]


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Sums of ``values[j] * base**j`` before each position."""
    out = np.zeros(len(values) + 1, U64)
    np.cumsum(values * _tables(len(values))[0], out=out[1:])
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span of symbols, wherever it stands; the length is part of it."""
    back = _tables(len(sums))[1]
    return mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(U64) * _STEP)


def window_hashes(values: np.ndarray, width: int) -> np.ndarray:
    """Hash of every window of ``width`` symbols."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, U64)
    sums = prefix_sums(values)
    return mix((sums[width:] - sums[:n]) * _tables(n)[1])


def is_space(data: np.ndarray) -> np.ndarray:
    """Bytes 0x20 and 0x09 to 0x0D."""
    return (data == 32) | ((data >= 9) & (data <= 13))


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every run of bytes that are no white space."""
    edge = np.flatnonzero(np.diff(np.concatenate(([True], is_space(data), [True])).astype(np.int8)))
    return edge[::2], edge[1::2]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word's bytes."""
    return span_hashes(prefix_sums(BYTE_VALUES[data]), starts, ends)


def _sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` (minimum or maximum) of every ``width`` values: running bests of blocks, forwards and backwards."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, values[-1], values.dtype)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    ahead = best.accumulate(grid, axis=1).ravel()
    behind = best.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(behind[: n - width + 1], ahead[width - 1 : n])


def anchors(hashes: np.ndarray, run: np.ndarray, width: int) -> np.ndarray:
    """Positions that hold the smallest hash of some ``width`` neighbouring positions of one run.

    ``run`` tells which run (document) a position belongs to. Equal stretches choose
    equal anchors, and every ``width`` positions in a row hold at least one.
    """
    n = len(hashes)
    if n < width:
        return np.zeros(0, np.int64)
    low = _sliding(hashes, width, np.minimum)
    low[run[: n - width + 1] != run[width - 1 :]] = 0
    edge = np.zeros(width - 1, U64)
    return np.flatnonzero(_sliding(np.concatenate((edge, low, edge)), width, np.maximum) == hashes)
