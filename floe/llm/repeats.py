"""What substring removal shares: finding stretches that may repeat, dealing them to shards, cutting them out.

A *window* is ``width`` symbols of one document. Every window is owned by the first of its
smallest ``gram``-symbol hashes (its anchor), so equal windows have equal anchors at the
same place. An anchor's *stretch* is the union of the windows it owns.

1. Every document yields its anchors with the hash of each stretch. Equal stretches at
   equal anchors are repeats in full and need no symbols. Those equal within a slice of
   texts are decided there, so that a line of a third of all documents sends a row per
   slice to its anchor; the others are decided by one sorted stream.
2. Of what is left at anchors that occur again, the symbols are fetched (one stretch
   standing for equal ones) and dealt to shards by anchor.
3. In a shard, stretches are cut down to what they share with any neighbour, what a whole
   group shares becomes one symbol, and the shard's index reports every substring that
   occurs at least twice and is at least a window long (see ``suffix`` and ``fmindex``).
   Groups beyond ``HOT`` stretches are decided by the hashes of their windows instead,
   pre-aggregated by Spark, so that no shard must hold a group without bound.
4. Reported spans are joined to the documents and cut out.

Rows are told apart by a 64-bit hash of id and text; equal rows share it and are treated
alike. Symbols are compared as bytes or 64-bit word hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floe.llm.common import flat, sliced, stored
from floe.llm.rolling import BYTE_VALUES, anchors, is_space, mix, prefix_sums, span_hashes, window_hashes, word_hashes, word_spans

HOT = 100_000
SHARD = 4_000

Symbols = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def byte_symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes as symbols, and the symbol offsets of each text."""
    return BYTE_VALUES[data], offsets


def split_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of all texts; no word spans two texts."""
    starts, ends = word_spans(data)
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    if len(cut):
        cut = np.unique(cut[~is_space(data[cut]) & ~is_space(data[cut - 1])])
        starts, ends = np.sort(np.concatenate((starts, cut))), np.sort(np.concatenate((ends, cut)))
    return starts, ends


def word_symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit word hashes as symbols, and the word offsets of each text."""
    starts, ends = split_words(data, offsets)
    hashes = word_hashes(data, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    return hashes, np.searchsorted(starts, offsets)


def stretches(values: np.ndarray, offsets: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, ...]:
    """Anchor hash, stretch hash, text, first window, anchor's place behind it and number of windows, per anchor."""
    n = len(values)
    empty = tuple(np.zeros(0, np.int64) for _ in range(6))
    if n < width:
        return empty
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    hashes = window_hashes(values, gram)
    run = np.where(text[: n - gram + 1] == text[gram - 1 :], text[: n - gram + 1], -1 - np.arange(n - gram + 1))
    reach = width - gram + 1
    at = anchors(hashes, run, reach)
    if not len(at):
        return empty
    h, doc = hashes[at], text[at]
    # the last anchor in front with a hash as small or smaller, the first behind with a smaller one
    before, after = np.arange(len(at)) - 1, np.arange(len(at)) + 1
    todo = np.arange(len(at))
    while len(todo):
        b = before[todo]
        ok = (b >= 0) & (h[b] > h[todo]) & (doc[b] == doc[todo]) & (at[todo] - at[b] < reach)
        todo = todo[ok]
        before[todo] -= 1
    todo = np.arange(len(at))
    while len(todo):
        a = np.minimum(after[todo], len(at) - 1)
        ok = (after[todo] < len(at)) & (h[a] >= h[todo]) & (doc[a] == doc[todo]) & (at[a] - at[todo] < reach)
        todo = todo[ok]
        after[todo] += 1
    far = 1 << 60
    q = np.where((before >= 0) & (doc[before] == doc), at[before], -far)
    nxt = np.minimum(after, len(at) - 1)
    r = np.where((after < len(at)) & (doc[nxt] == doc), at[nxt], far)
    first = np.maximum.reduce([offsets[doc], at - reach + 1, q + 1])
    last = np.minimum.reduce([offsets[doc + 1] - width, at, r - reach])
    keep = last >= first
    at, h, doc, first, last = at[keep], h[keep], doc[keep], first[keep], last[keep]
    whole = span_hashes(prefix_sums(values), first, last + width)
    whole = mix(whole + (at - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return h.view(np.int64), whole.view(np.int64), doc, first - offsets[doc], at - first, last - first + 1


def keyed(docs: DataFrame, *carried: str) -> DataFrame:
    """doc_id, text, carried columns and the row's key."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), *carried)
    return rows.withColumn("uid", F.xxhash64("doc_id", "text"))


def _anchor_rows(symbols: Symbols, width: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            values, offsets = symbols(*flat(batch.column("text")))
            h, whole, doc, first, place, windows = stretches(values, offsets, width, gram)
            uid = batch.column("uid").to_numpy()[doc]
            spot = (first << 24) | (place << 12) | windows
            # stretches that are equal within this slice are decided here: one row speaks for them at their anchor,
            # they themselves are dealt anywhere
            _, lead, group, many = np.unique(whole, return_index=True, return_inverse=True, return_counts=True)
            lead = lead[many > 1]
            sure = many[group] > 1 if len(group) else np.zeros(0, bool)
            at = np.concatenate((np.arange(len(h)), lead))
            state = np.concatenate((np.where(sure, SURE, ALONE), np.full(len(lead), SPEAKS))).astype(np.int8)
            deal = np.where(state == SURE, mix((spot[at] ^ uid[at]).view(np.uint64)).view(np.int64), h[at])
            rows = {"deal": deal, "anchor": h[at], "whole": whole[at], "uid": uid[at], "spot": spot[at]}
            yield pa.record_batch({k: pa.array(v, pa.int64()) for k, v in rows.items()} | {"state": pa.array(state)})

    return run


#: a stretch on its way to its anchor: not seen twice yet, known to be repeated, speaking for such
ALONE, SURE, SPEAKS = 0, 1, 2


#: what becomes of a stretch: repeated in full, open, or only standing for its equals
FULL, OPEN, STAND_IN = 0, 1, 2


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by anchor and stretch: those whose anchor occurs again, and what becomes of them.

    One row is held back, with what is known of the rows in front of it. The first of equal
    stretches stands in for them where their anchor has other stretches.
    """
    names = ("anchor", "whole", "uid", "spot", "state")
    tail: tuple | None = None  # the held row; whether its anchor and its stretch occurred before
    for batch in batches:
        rows = [batch.column(c).to_numpy() for c in names]
        sure = rows[4] == SURE
        if sure.any():
            yield _outcome(*(r[sure] for r in rows[:4]), np.full(int(sure.sum()), FULL, np.int8))
            rows = [r[~sure] for r in rows]
        if not len(rows[0]):
            continue
        seen_a = seen_w = False
        if tail is not None:
            held, seen_a, seen_w = tail
            rows = [np.concatenate(([x], y)) for x, y in zip(held, rows)]
        a, w = rows[:2]
        same_a = a[1:] == a[:-1]
        same_w = same_a & (w[1:] == w[:-1])
        before_a, before_w = np.concatenate(([seen_a], same_a)), np.concatenate(([seen_w], same_w))
        after_a, after_w = np.concatenate((same_a, [False])), np.concatenate((same_w, [False]))
        # whether an anchor has several stretches is not known at the borders of a batch
        run = np.cumsum(np.concatenate(([0], ~same_a)))
        ends = np.append(np.flatnonzero(~same_a), len(a) - 1)
        several = w[ends] != w[np.concatenate(([0], ends[:-1] + 1))]
        several[0] |= seen_a
        several[-1] = True
        yield from _decided(*(r[:-1] for r in rows), (before_a | after_a)[:-1], before_w[:-1], after_w[:-1], several[run][:-1])
        tail = (tuple(r[-1] for r in rows), bool(before_a[-1]), bool(before_w[-1]))
    if tail is not None:
        row, seen_a, seen_w = tail
        yield from _decided(*(np.array([x]) for x in row), np.array([seen_a]), np.array([seen_w]), np.array([False]), np.array([seen_a]))


def _outcome(anchor, whole, uid, spot, kind) -> pa.RecordBatch:
    return pa.record_batch({"uid": pa.array(uid), "anchor": pa.array(anchor), "spot": pa.array(spot), "kind": pa.array(kind)})


def _decided(a, w, u, s, state, again, before_w, after_w, several) -> Iterator[pa.RecordBatch]:
    speaks, equal = state == SPEAKS, before_w | after_w
    own = again & ~speaks
    rows = [(np.flatnonzero(own & equal), FULL), (np.flatnonzero(own & ~equal), OPEN), (np.flatnonzero((after_w | speaks) & ~before_w & several), STAND_IN)]
    at = np.concatenate([r for r, _ in rows])
    yield _outcome(a[at], w[at], u[at], s[at], np.concatenate([np.full(len(r), k, np.int8) for r, k in rows]))


def _fetch(symbols: Symbols, width: int, as_bytes: bool):
    """The symbols of the open stretches of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            data, text_offsets = flat(batch.column("text"))
            values, offsets = symbols(data, text_offsets)
            values = data if as_bytes else values
            wanted = batch.column("wanted")
            many = np.diff(wanted.offsets.to_numpy())
            rows = wanted.flatten()
            anchor, spot, kind = (rows.field(k).to_numpy() for k in range(3))
            doc = np.repeat(np.arange(batch.num_rows), many)
            first = (spot >> 24) + offsets[doc]
            size = (spot & 0xFFF) + width - 1
            at = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())
            raw = np.ascontiguousarray(values[at]).tobytes()
            unit = values.itemsize
            ends = np.concatenate(([0], np.cumsum(size * unit))).astype(np.int32)
            content = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(raw)])
            uid = batch.column("uid").to_numpy()
            yield pa.record_batch({"anchor": pa.array(anchor), "uid": pa.array(uid[doc]), "spot": pa.array(spot), "kind": pa.array(kind), "content": content})

    return run


class Group:
    """The stretches of one anchor as rows of symbols around it, 0 where a stretch has ended."""

    def __init__(self, contents: list[bytes], spots: np.ndarray, width: int, gram: int, kind: type):
        self.place = (spots >> 12) & 0xFFF
        size = (spots & 0xFFF) + width - 1
        self.right_size = size - self.place - gram
        lw, rw = int(self.place.max()), int(self.right_size.max())
        n = len(contents)
        dtype = np.uint16 if kind is np.uint8 else np.uint64
        self.left, self.right = np.zeros((n, lw), dtype), np.zeros((n, rw), dtype)
        bump = 1 if kind is np.uint8 else 0
        for i, raw in enumerate(contents):
            x = np.frombuffer(raw, kind)
            p = self.place[i]
            self.left[i, :p] = x[:p][::-1]
            self.right[i, : self.right_size[i]] = x[p + gram :]
        if bump:
            self.left += np.arange(lw) < self.place[:, None]
            self.right += np.arange(rw) < self.right_size[:, None]
        else:  # a word hash of 0 would look like an end
            self.left[(self.left == 0) & (np.arange(lw) < self.place[:, None])] = 1
            self.right[(self.right == 0) & (np.arange(rw) < self.right_size[:, None])] = 1

    @staticmethod
    def shared(rows: np.ndarray) -> tuple[np.ndarray, int]:
        """For each row the longest beginning it shares with any other, and the beginning all share."""
        n, w = rows.shape
        if not w:
            return np.zeros(n, np.int64), 0
        order = np.lexsort(rows.T[::-1]) if rows.dtype == np.uint64 else np.argsort(np.ascontiguousarray(rows.astype(">u2")).view(f"S{2 * w}").ravel(), kind="stable")
        s = rows[order]
        differ = (s[1:] != s[:-1]) | (s[1:] == 0)
        same = np.where(differ.any(1), differ.argmax(1), w)
        best = np.zeros(n, np.int64)
        best[order[1:]] = same
        best[order[:-1]] = np.maximum(best[order[:-1]], same)
        return best, int(same.min()) if len(same) else w


class Shard:
    """Several groups laid out as short strings of symbols, each with a weight, and where they came from."""

    def __init__(self, width: int, gram: int):
        self.width, self.gram = width, gram
        self.strings: list[np.ndarray] = []
        self.weights: list[np.ndarray] = []
        self.cores: list[int] = []
        self.origin: list[list[tuple[int, int]]] = []  # (row, first symbol within the stretch)
        self.next_core = 1

    def add(self, group: Group, rows: np.ndarray) -> None:
        live = np.arange(len(rows))
        for _ in range(3):  # what shares too little with all others goes, so that the rest may share more
            left_most, left_all = Group.shared(group.left[live])
            right_most, right_all = Group.shared(group.right[live])
            enough = left_most + right_most + self.gram >= self.width
            live, left_most, right_most = live[enough], left_most[enough], right_most[enough]
            if len(live) < 2:
                return
            if enough.all():
                break
        core = np.uint64(self.next_core)
        self.next_core += 1
        known: dict[bytes, list[int]] = {}
        for i, a, b in zip(live.tolist(), left_most.tolist(), right_most.tolist()):
            x = np.concatenate((group.left[i, left_all:a][::-1], [0], group.right[i, right_all:b])).astype(np.uint64)
            key = x.tobytes() + a.to_bytes(4, "little")
            came = (int(rows[i]), int(group.place[i]) - a)
            if key in known and len(known[key]) >= 2:
                self.origin[known[key][0]].append(came)
                continue
            known.setdefault(key, []).append(len(self.strings))
            y = mix(x + np.uint64(7))  # apart from the cores
            y[a - left_all] = mix(np.array([core], np.uint64) ^ np.uint64(0x5555555555555555))[0]
            w = np.ones(len(y), np.int64)
            w[a - left_all] = left_all + self.gram + right_all
            self.strings.append(y)
            self.weights.append(w)
            self.cores.append(a - left_all)
            self.origin.append([came])

    def text(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All strings as one row of ranks (0 is the separator behind each), the weights before each place, the starts."""
        if not self.strings:
            return np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(0, np.int64)
        names, ranks = np.unique(np.concatenate(self.strings), return_inverse=True)
        sizes = np.array([len(s) for s in self.strings])
        starts = np.cumsum(sizes + 1) - sizes - 1
        out = np.zeros(int((sizes + 1).sum()), np.int64)
        weight = np.zeros(len(out), np.int64)
        at = np.arange(len(ranks)) + np.repeat(np.arange(len(sizes)), sizes)
        out[at], weight[at] = ranks + 1, np.concatenate(self.weights)
        return out, np.concatenate(([0], np.cumsum(weight))), starts


def _in_shards(width: int, gram: int, kind: type, report, hot_size: int):
    """Streams stretches sorted by anchor; yields spans of repeats, and the windows of groups too large for a shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def spans(groups) -> pa.RecordBatch:
            shard = Shard(width, gram)
            uid, spot, state = (np.concatenate([g[k] for g in groups]) for k in (0, 1, 2))
            base = 0
            for u, s, k, contents in groups:
                shard.add(Group(contents, s, width, gram, kind), np.arange(base, base + len(u)))
                base += len(u)
            row, low, high = [], [], []
            for string, begin, end in report(shard):
                for r, shift in shard.origin[string]:
                    if state[r] == OPEN:
                        row.append(r)
                        low.append(begin + shift)
                        high.append(end + shift)
            row = np.array(row, np.int64)
            first = spot[row] >> 24
            return batch_of(uid[row], first + np.array(low, np.int64), first + np.array(high, np.int64), np.zeros(len(row), np.int64))

        def batch_of(uid, low, high, window) -> pa.RecordBatch:
            return pa.record_batch({"uid": pa.array(uid, pa.int64()), "low": pa.array(low, pa.int64()), "high": pa.array(high, pa.int64()), "window": pa.array(window, pa.int64())})

        def hot(anchor, u, s, k, contents) -> Iterator[pa.RecordBatch]:
            for i in range(len(u)):
                x = np.frombuffer(contents[i], kind)
                x = BYTE_VALUES[x] if kind is np.uint8 else x
                w = window_hashes(x, width)
                name = mix(w + np.uint64(anchor & (1 << 64) - 1)).view(np.int64)
                name[name == 0] = 1
                first = (int(s[i]) >> 24) + np.arange(len(w))
                owner = np.full(len(w), u[i])
                # a stand-in speaks for two stretches, so it makes its windows repeats by itself
                for _ in range(2 if k[i] == STAND_IN else 1):
                    yield batch_of(owner, first if k[i] == OPEN else np.full(len(w), -1), first + width, name)

        pending: list[tuple] = []
        size = 0
        current: list[pa.RecordBatch] = []
        key, overflow, count = None, False, 0

        def close():
            nonlocal current, count, size
            if not current:
                return
            rows = pa.Table.from_batches(current)
            u, s, k = (rows.column(c).to_numpy() for c in ("uid", "spot", "kind"))
            contents = rows.column("content").to_pylist()
            current, count = [], 0
            if overflow:
                yield from hot(key, u, s, k, contents)
            elif len(u) > 1:
                pending.append((u, s, k, contents))
                size += len(u)
                if size >= SHARD:
                    yield spans(pending)
                    pending.clear()
                    size = 0

        for batch in batches:
            anchor = batch.column("anchor").to_numpy()
            if not len(anchor):
                continue
            edges = np.concatenate(([0], np.flatnonzero(anchor[1:] != anchor[:-1]) + 1, [len(anchor)]))
            for a, b in zip(edges[:-1], edges[1:]):
                if anchor[a] != key:
                    yield from close()
                    key, overflow = int(anchor[a]), False
                current.append(batch.slice(a, b - a))
                count += b - a
                if count > hot_size:
                    overflow = True
                    yield from close()
        yield from close()
        if pending:
            yield spans(pending)

    return run


def repeated_spans(docs: DataFrame, symbols: Symbols, kind: type, width: int, gram: int, report, hot_size: int = HOT) -> DataFrame:
    """(uid, low, high): symbol spans of repeated windows, of documents from ``keyed``.

    ``report`` finds the repeats of a shard; an anchor of more than ``hot_size`` stretches is decided by window hashes.
    """
    rows = docs.select("uid", "text").mapInArrow(_anchor_rows(symbols, width, gram), "deal bigint, anchor bigint, whole bigint, uid bigint, spot bigint, state tinyint")
    decided = rows.repartition("deal").sortWithinPartitions("anchor", "whole").mapInArrow(_decide, "uid bigint, anchor bigint, spot bigint, kind tinyint")
    decided = stored(decided, "stretches")
    full = decided.filter(F.col("kind") == FULL).select("uid", (F.shiftright("spot", 24)).alias("low"), (F.shiftright("spot", 24) + F.col("spot").bitwiseAND(0xFFF) + width - 1).alias("high"))
    wanted = decided.filter(F.col("kind") != FULL).groupBy("uid").agg(F.collect_list(F.struct("anchor", "spot", "kind")).alias("wanted"))
    opened = docs.select("uid", "text").join(wanted.hint("shuffle_hash"), "uid")
    fetched = opened.mapInArrow(_fetch(symbols, width, kind is np.uint8), "anchor bigint, uid bigint, spot bigint, kind tinyint, content binary")
    in_shards = fetched.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_in_shards(width, gram, kind, report, hot_size), "uid bigint, low bigint, high bigint, window bigint")
    found = stored(in_shards, "spans")
    direct = found.filter("window = 0").select("uid", "low", "high")
    windows = found.filter("window <> 0")
    again = windows.groupBy("window").agg(F.count("*").alias("n")).filter("n > 1").select("window")
    from_windows = windows.filter("low >= 0").join(again, "window", "left_semi").select("uid", "low", "high")
    return full.unionByName(direct).unionByName(from_windows)


def covered(spans: pa.Array, offsets: np.ndarray) -> np.ndarray:
    """Which symbols of all texts lie in a span of their text."""
    mark = np.zeros(int(offsets[-1]) + 1, np.int64)
    many = pc.fill_null(pc.list_value_length(spans), 0).to_numpy()
    rows = spans.flatten()
    doc = np.repeat(np.arange(len(many)), many)
    np.add.at(mark, rows.field(0).to_numpy() + offsets[doc], 1)
    np.add.at(mark, rows.field(1).to_numpy() + offsets[doc], -1)
    return np.cumsum(mark)[:-1] > 0


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Documents from ``keyed`` with the list of their spans (null without)."""
    gathered = spans.distinct().groupBy("uid").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    return docs.join(gathered.hint("shuffle_hash"), "uid", "left").drop("uid")


