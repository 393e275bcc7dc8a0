"""Removal of repeated word runs by compressed FM-indexes.

Each shard's text is indexed as a Burrows-Wheeler transform in a wavelet tree of packed
bits. Its strings are then streamed back through backward search, all at once: a match
ends at each place and grows to the left while at least two occurrences are left. What is
longest is the matching statistic of the place; where it is a window long the interval is
reported.

Defined cases: null texts have no words; texts under the width keep every word; repeated
rows are repeats of each other, so both lose all windows; null ids are allowed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from floe.llm.common import flat, sliced
from floe.llm.repeats import HOT, Shard, covered, keyed, repeated_spans, split_words, with_spans, word_symbols

CUT = "doc_id bigint, n_words bigint, n_removed bigint, spans array<struct<low:bigint,high:bigint>>, kept string"


def sorted_rotations(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a text by doubling: ranks of two halves are sorted until all differ."""
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    n, step = len(text), 1
    while True:
        behind = np.zeros(n, np.int64)
        behind[: n - step] = rank[step:] + 1
        key = rank * (n + 1) + behind
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        new = np.concatenate(([0], np.cumsum(ranked[1:] != ranked[:-1])))
        rank = np.empty(n, np.int64)
        rank[order] = new
        step *= 2
        if new[-1] == n - 1 or step >= n:
            return order


class Bits:
    """A bit row in 64-bit words with the number of ones before each word."""

    def __init__(self, bits: np.ndarray):
        n = len(bits) // 64 + 1
        padded = np.zeros(n * 64, bool)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words)))).astype(np.int32)

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones in front of each place."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class FMIndex:
    """Backward search over a text of ranks (0 is the separator) through a wavelet tree."""

    def __init__(self, text: np.ndarray):
        order = sorted_rotations(text)
        last = text[order - 1]  # the symbol in front of each suffix, around the end
        self.n, size = len(text), int(text.max()) + 1
        self.less = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=size))))
        self.levels: list[tuple[Bits, int]] = []
        row = last
        for bit in range(max(1, (size - 1).bit_length()) - 1, -1, -1):
            ones = (row >> bit & 1).astype(bool)
            self.levels.append((Bits(ones), int((~ones).sum())))
            row = np.concatenate((row[~ones], row[ones]))
        self.depth = len(self.levels)

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands in front of a place of the transform."""
        start, at = np.zeros(len(at), np.int64), at.astype(np.int64)
        for k, (bits, zeros) in enumerate(self.levels):
            one = (symbol >> (self.depth - 1 - k) & 1).astype(bool)
            a, b = bits.ones(start), bits.ones(at)
            start, at = np.where(one, zeros + a, start - a), np.where(one, zeros + b, at - b)
        return at - start

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The interval of suffixes that begin with the symbol and go on as those of [low, high)."""
        both = self.rank(np.concatenate((symbol, symbol)), np.concatenate((low, high)))
        return self.less[symbol] + both[: len(symbol)], self.less[symbol] + both[len(symbol) :]


def repeats_in(shard: Shard) -> Iterator[tuple[int, int, int]]:
    """(string, begin, end) of every longest repeat of a shard that is a window long, in unweighted symbols of the string.

    Only matches that hold a string's weighted symbol can be a window long, so matches end there or behind it.
    """
    text, weight, starts = shard.text()
    if not len(text):
        return
    index = FMIndex(text)
    sizes = np.append(starts[1:], len(text)) - 1 - starts
    core = starts + np.array(shard.cores)
    behind = starts + sizes - core
    string = np.repeat(np.arange(len(starts)), behind)
    end = np.repeat(core - (np.cumsum(behind) - behind), behind) + np.arange(behind.sum())
    reached = end + 1
    low, high = index.less[text[end]], index.less[text[end] + 1]
    lane, at = np.arange(len(end)), end
    alive = high - low >= 2
    lane, at, low, high = lane[alive], at[alive], low[alive], high[alive]
    while len(lane):
        reached[lane] = at
        more = at > starts[string[lane]]
        lane, at, low, high = lane[more], at[more] - 1, low[more], high[more]
        low, high = index.extend(text[at], low, high)
        alive = high - low >= 2
        lane, at, low, high = lane[alive], at[alive], low[alive], high[alive]
    found = np.flatnonzero(weight[end + 1] - weight[reached] >= shard.width)
    base = weight[starts[string]]
    for i in found:
        yield int(string[i]), int(weight[reached[i]] - base[i]), int(weight[end[i] + 1] - base[i])


def remove_repeats(docs: DataFrame, width: int = 35, gram: int = 8, hot_size: int = HOT) -> DataFrame:
    """doc_id, n_words, n_removed, spans (maximal removed runs of words) and kept (the rest joined by one space)."""
    rows = keyed(docs)
    spans = repeated_spans(rows, word_symbols, np.uint64, width, gram, repeats_in, hot_size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            data, text_offsets = flat(batch.column("text"))
            starts, ends = split_words(data, text_offsets)
            offsets = np.searchsorted(starts, text_offsets)
            gone = covered(batch.column("spans"), offsets)
            keep = np.flatnonzero(~gone)
            size = ends[keep] - starts[keep] + 1
            # every kept word with a space behind it, in one gather
            at = np.repeat(starts[keep] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            text = np.append(data, np.uint8(32))[at] if len(at) else np.zeros(0, np.uint8)
            text[np.cumsum(size) - 1] = 32
            until = np.concatenate(([0], np.cumsum(size)))[np.searchsorted(keep, offsets)]
            out = {"doc_id": batch.column("doc_id"), "n_words": pa.array(np.diff(offsets), pa.int64())}
            removed, spans, kept = [], [], []
            for k in range(batch.num_rows):
                mask = gone[offsets[k] : offsets[k + 1]]
                edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
                removed.append(int(mask.sum()))
                spans.append([{"low": int(a), "high": int(b)} for a, b in zip(edge[::2], edge[1::2])])
                kept.append(text[until[k] : max(until[k], until[k + 1] - 1)].tobytes().decode())
            span = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))
            yield pa.record_batch(out | {"n_removed": pa.array(removed, pa.int64()), "spans": pa.array(spans, span), "kept": pa.array(kept, pa.string())})

    return with_spans(rows, spans).mapInArrow(run, CUT)
