"""Removal of repeated byte strings by suffix arrays, built by linear grouping.

The suffix array of a shard's text is made in two passes without recursive renaming.
First suffixes are grouped by the longest Lyndon word they begin with: groups start as
single symbols and are processed from the highest; each suffix of the group points to
the last smaller one in front of it, and those pointed at are moved behind the rest of
their group, further the more suffixes point at them. Then suffixes are emitted in
order: the one emitted places, group by group, all suffixes whose Lyndon word ends where
it begins. Of neighbours in the array, those that share at least a window are repeats.

The array is built over the symbols of ``repeats.Shard``: bytes at the edges of what a
group of stretches shares, one weighted symbol for what all of them share.

Defined cases: null texts are empty; texts under the width keep every byte; repeated rows
are repeats of each other, so both lose all windows; null ids are allowed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from floe.llm.common import bounded_batches, flat, sliced
from floe.llm.repeats import HOT, Shard, byte_symbols, covered, keyed, repeated_spans, with_spans

CUT = "doc_id bigint, n_bytes bigint, n_removed bigint, spans array<struct<low:bigint,high:bigint>>, kept binary"


def suffix_array(text: list[int]) -> list[int]:
    """Order of the suffixes of a list of non-negative whole numbers (an end sorts before everything)."""
    n = len(text)
    if not n:
        return []
    # groups are runs of `order`; place[i] is where suffix i stands in it, group[i] where its run starts
    order = sorted(range(n), key=text.__getitem__)
    place, group, size = [0] * n, [0] * n, [0] * (n + 1)
    start, value = 0, None
    for k, i in enumerate(order):
        if text[i] != value:
            start, value = k, text[i]
        place[i], group[i] = k, start
        size[start] += 1
    smaller = [-1] * n
    end = n
    while end:
        begin = group[order[end - 1]]
        members = order[begin:end]
        if len(members) > 1:
            members.sort()
        pointed: dict[int, int] = {}
        for i in members:
            p = i - 1
            while p >= 0 and group[p] >= begin:
                p = smaller[p]  # known: of a higher group, or of this one and further in front
            smaller[i] = p
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + 1
        if pointed:
            most = max(pointed.values())
            if most == 1:
                _move(list(pointed), order, place, group, size)
            else:
                by_count: dict[int, list[int]] = {}
                for p, c in pointed.items():
                    by_count.setdefault(c, []).append(p)
                for c in sorted(by_count, reverse=True):
                    _move(by_count[c], order, place, group, size)
        end = begin
    # second pass: from the end of the text on, every emitted suffix places those that end in it
    out = [-1] * n
    done = [False] * n
    front = list(range(n))
    k, i = -1, n
    while True:
        p = i - 1
        while p >= 0 and not done[p]:
            g = group[p]
            out[front[g]] = p
            front[g] += 1
            done[p] = True
            p = smaller[p]
        k += 1
        if k >= n:
            return out
        i = out[k]


def _move(chosen: list[int], order: list[int], place: list[int], group: list[int], size: list[int]) -> None:
    """Move suffixes to the end of their groups, where they form new ones."""
    for p in chosen:
        g = group[p]
        size[g] -= 1
        last = g + size[g]
        at = place[p]
        if at != last:
            other = order[last]
            order[at], order[last] = other, p
            place[other], place[p] = at, last
    for p in chosen:
        g = group[p]
        new = g + size[g]
        group[p] = new
    for p in chosen:
        size[group[p]] += 1


def shared_beginnings(text: list[int], order: list[int]) -> np.ndarray:
    """How many symbols each suffix shares with the one before it in the order (indexed by suffix)."""
    n = len(text)
    before = [-1] * n
    for a, b in zip(order, order[1:]):
        before[b] = a
    out, h = [0] * n, 0
    for i in range(n):
        j = before[i]
        if j < 0:
            h = 0
            continue
        top = n - max(i, j)
        while h < top and text[i + h] == text[j + h]:
            h += 1
        out[i] = h
        if h:
            h -= 1
    return np.array(out, np.int64)


def repeats_in(shard: Shard) -> Iterator[tuple[int, int, int]]:
    """(string, begin, end) of every longest repeat of a shard that is a window long, in unweighted symbols of the string."""
    text, weight, starts = shard.text()
    if not len(text):
        return
    symbols = text.tolist()
    order = suffix_array(symbols)
    with_before = shared_beginnings(symbols, order)
    rank = np.array(order, np.int64)
    with_after = np.zeros(len(text), np.int64)
    with_after[rank[:-1]] = with_before[rank[1:]]
    longest = np.maximum(with_before, with_after)
    # a repeat ends with its string
    ends = np.append(starts[1:], len(text)) - 1
    string = np.searchsorted(starts, np.arange(len(text)), "right") - 1
    stop = np.minimum(np.arange(len(text)) + longest, ends[string])
    for i in np.flatnonzero(weight[stop] - weight[:-1] >= shard.width):
        k = int(string[i])
        yield k, int(weight[i] - weight[starts[k]]), int(weight[stop[i]] - weight[starts[k]])


def remove_repeats(docs: DataFrame, width: int = 200, gram: int = 60, hot_size: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (maximal removed runs) and kept (the remaining bytes) of every document."""
    rows = keyed(docs)
    spans = repeated_spans(rows, byte_symbols, np.uint8, width, gram, repeats_in, hot_size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            data, offsets = flat(batch.column("text"))
            gone = covered(batch.column("spans"), offsets)
            out = {"doc_id": [], "n_bytes": [], "n_removed": [], "spans": [], "kept": []}
            for k, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                mask = gone[offsets[k] : offsets[k + 1]]
                edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
                kept = data[offsets[k] : offsets[k + 1]][~mask].tobytes()
                for name, value in zip(out, (doc_id, len(mask), int(mask.sum()), [{"low": int(a), "high": int(b)} for a, b in zip(edge[::2], edge[1::2])], kept)):
                    out[name].append(value)
            span = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))
            kinds = (pa.int64(), pa.int64(), pa.int64(), span, pa.binary())
            yield pa.record_batch({n: pa.array(v, t) for (n, v), t in zip(out.items(), kinds)})

    return with_spans(rows, spans).mapInArrow(run, CUT)


def without_repeats(docs: DataFrame, width: int = 200, gram: int = 60) -> DataFrame:
    """doc_id, text (whole characters that a repeat covers are cut out), lang, source, n_chars of every document."""
    bounded_batches(docs.sparkSession)
    rows = keyed(docs, "lang", "source")
    spans = repeated_spans(rows, byte_symbols, np.uint8, width, gram, repeats_in)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            data, offsets = flat(batch.column("text"))
            gone = covered(batch.column("spans"), offsets)
            first = np.flatnonzero((data & 0xC0) != 0x80)
            if len(first):  # a character goes if all of its bytes do
                gone = np.repeat(np.logical_and.reduceat(gone, first), np.diff(np.append(first, len(data))))
            kept = [data[a:b][~gone[a:b]].tobytes().decode() for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "text": pa.array(kept, pa.string()), "lang": batch.column("lang"), "source": batch.column("source"),
                "n_chars": pa.array([len(t) for t in kept], pa.int64()),
            })

    return with_spans(rows, spans).mapInArrow(run, "doc_id bigint, text string, lang string, source string, n_chars bigint")
