"""Benchmark passages in documents, by embedding edit distance into Hamming distance.

Texts are lower-cased words (A-Z only, split at white space). A document contains an item
of n words when some run of its words is within ``floor(allowed * n)`` word edits of it.

Item-sized windows of every document are embedded by random walks (a word is repeated or
left behind by a random bit of its hash, so that one edit disturbs the walk only for a
while). Repeated samples of three coordinates are the keys of a locality-sensitive hash;
``repeats`` is chosen so that recall at the full allowed distance of a fifth stays above
0.95 (see the test). Windows that meet an item under a key are verified by exact edit distance.
Walks that differ by many edits drift apart, so an item of over ``PIECE`` words is looked
up by pieces of about equal length: one of them at least is within its own share of the
edits. Where a piece is verified, all places of the whole item that it allows are.
A window can only be near an item if they share ceil((n - d) / (d + 1)) words in a row,
d being the allowed edits; windows without any such run are not embedded, which loses none.

Items are taken in blocks of ``block`` rows, so what is broadcast is bounded.

Defined cases: null or empty texts and items match nothing; items under ``min_words``
words are no passages and are left out; a document that repeats an item is listed once per
item, at its nearest place (ties: the first). Repeated rows are listed each. An item or a
document without an id is searched like any other; its id is null in the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floe.llm.common import bounded_batches, flat, sliced
from floe.llm.rolling import is_space, mix, window_hashes, word_hashes, word_spans

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: the most words that are embedded as one
PIECE = 50
FOUND = "doc_id bigint, item_id bigint, word_start bigint, n_words bigint, distance bigint, similarity double"


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of all texts and the text of each."""
    data = _LOWER[data]
    starts, ends = word_spans(data)
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    cut = np.unique(cut[~is_space(data[cut]) & ~is_space(data[cut - 1])]) if len(cut) else cut
    starts, ends = np.sort(np.concatenate((starts, cut))), np.sort(np.concatenate((ends, cut)))
    return word_hashes(data, starts, ends), np.searchsorted(offsets, starts, "right") - 1


class Items:
    """A block of benchmark items with their hash keys."""

    def __init__(self, ids: list[int], texts: list[str], allowed: float, min_words: int, walks: int, repeats: int, seed: int = 11):
        kept = []
        for item_id, text in zip(ids, texts):
            raw = np.frombuffer((text or "").encode(), np.uint8)
            words, _ = words_of(raw, np.array([0, len(raw)]))
            if len(words) >= max(1, min_words):
                kept.append((item_id, words))
        self.ids = [k for k, _ in kept]
        self.whole = [w for _, w in kept]
        self.whole_edits = np.array([int(allowed * len(w) + 1e-9) for w in self.whole], np.int64)
        #: what is embedded: the item of each piece and where in it the piece begins
        cuts = [np.linspace(0, len(w), -(-len(w) // PIECE) + 1).astype(np.int64) for w in self.whole]
        self.item = np.repeat(np.arange(len(kept)), [len(c) - 1 for c in cuts])
        self.at = np.concatenate([np.zeros(0, np.int64), *(c[:-1] for c in cuts)])
        self.words = [w[i:j] for w, c in zip(self.whole, cuts) for i, j in zip(c, c[1:])]
        self.n = np.array([len(w) for w in self.words], np.int64)
        self.edits = np.floor(allowed * self.n + 1e-9).astype(np.int64)
        rng = np.random.default_rng(seed)
        self.walks, self.repeats = walks, repeats
        self.salts = rng.integers(1, 2**63, walks, dtype=np.uint64)
        self.sample = rng.random((repeats, 3))
        if not kept:
            return
        runs = np.minimum(-(-(self.n - self.edits) // (self.edits + 1)), 4)
        self.grams = {int(g): np.unique(np.concatenate([window_hashes(w, int(g)) for w, r in zip(self.words, runs) if r == g])) for g in np.unique(runs)}
        self.reach = {int(g): int((self.n + self.edits)[runs == g].max()) for g in self.grams}
        self.steps = int(1.6 * self.n.max()) + 1
        #: items of like length share their sampled coordinates
        self.band = np.floor(np.log(self.n) / np.log(1.15)).astype(np.int64)
        self.bands = np.unique(self.band)
        self.span = {int(b): int(1.6 * self.n[self.band == b].min()) for b in self.bands}
        longest = int(self.n.max())
        grid = np.zeros((len(self.words), longest + self.steps + 1), np.uint64)
        for k, w in enumerate(self.words):
            grid[k, : len(w)] = w
        self.padded = grid
        starts = np.arange(len(self.words)) * grid.shape[1]
        own = self.keys(grid.ravel(), starts)
        self.index = {}
        for b in self.bands:
            at = np.flatnonzero(self.band == b)
            keys = own[int(b)][at].ravel()
            order = np.argsort(keys, kind="stable")
            self.index[int(b)] = (keys[order], np.repeat(at, repeats)[order])

    def keys(self, words: np.ndarray, starts: np.ndarray) -> dict[int, np.ndarray]:
        """For each band of lengths the ``repeats`` keys of the windows at ``starts``."""
        embedded = np.zeros((self.walks, self.steps, len(starts)), np.uint64)
        last = len(words) - 1
        for v in range(self.walks):
            coins, at = None, starts.copy()
            for j in range(self.steps):
                if j % 64 == 0:
                    coins = mix(words * np.uint64(2) + self.salts[v : v + 1] * np.uint64(2 * j + 1))
                embedded[v, j] = words[at]
                at = np.minimum(at + ((coins[at] >> np.uint64(j % 64)) & np.uint64(1)).astype(np.int64), last)
        out = {}
        for b in self.bands:
            place = (self.sample * self.span[int(b)]).astype(int)
            made = np.empty((len(starts), self.repeats), np.uint64)
            for r in range(self.repeats):
                v = r % self.walks
                key = np.full(len(starts), r + 1, np.uint64)
                for j in place[r]:
                    key = mix(key * np.uint64(0x9E3779B97F4A7C15) + embedded[v, j])
                made[:, r] = key
            out[int(b)] = made
        return out


def edit_distances(texts: np.ndarray, items: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row: the least number of word edits between the first ``n`` words of an item and any beginning of
    a text row, and how many words that beginning has (the longest where several do).
    """
    width = texts.shape[1]
    column = np.arange(width + 1)
    row = np.broadcast_to(column, (len(texts), width + 1)).astype(np.int64)
    best, length = row.min(1).copy(), row.argmin(1)
    for i in range(items.shape[1]):
        step = np.empty_like(row)
        step[:, 0] = i + 1
        step[:, 1:] = np.minimum(row[:, 1:] + 1, row[:, :-1] + (texts != items[:, i, None]))
        row = np.minimum.accumulate(step - column, axis=1) + column
        ended = n == i + 1
        if ended.any():
            best[ended] = row[ended].min(1)
            length[ended] = width - row[ended][:, ::-1].argmin(1)
    return best, length


def nearest_place(text: np.ndarray, item: np.ndarray, starts: list[tuple[int, int]]) -> tuple[int, int, int]:
    """(distance, first word, words) of the nearest place of an item that begins in one of the ranges of a text."""
    n, best = len(item), (len(item) + 1, 0, 0)
    edges = sorted(starts)
    while edges:
        low, high = edges.pop(0)
        while edges and edges[0][0] <= high + 1:
            high = max(high, edges.pop(0)[1])
        # read backwards, the last row has the least distance for each first word
        back = text[low : high + 2 * n][::-1]
        column = np.arange(len(back) + 1)
        row = np.zeros(len(back) + 1, np.int64)
        for i, word in enumerate(item[::-1]):
            step = np.empty_like(row)
            step[0] = i + 1
            step[1:] = np.minimum(row[1:] + 1, row[:-1] + (back != word))
            row = np.minimum.accumulate(step - column) + column
        by_start = row[::-1][: high - low + 1]
        k = int(by_start.argmin())
        if by_start[k] < best[0]:
            _, length = edit_distances(text[None, low + k : low + k + 2 * n], item[None], np.array([n]))
            best = int(by_start[k]), low + k, int(length[0])
    return best


def find(batch_words: np.ndarray, owner: np.ndarray, items: Items) -> list[tuple[int, int, int, int, int]]:
    """(text, item, first word in the text, words, distance) of the nearest place of each item in each text."""
    total = len(batch_words)
    wanted = np.zeros(total, bool)
    for g, grams in items.grams.items():
        if total < g:
            continue
        hashes = window_hashes(batch_words, g)
        at = np.minimum(np.searchsorted(grams, hashes), len(grams) - 1)
        hits = np.flatnonzero((grams[at] == hashes) & (owner[: total - g + 1] == owner[g - 1 :]))
        mark = np.zeros(total + 1, np.int64)
        np.add.at(mark, np.maximum(0, hits - items.reach[g] + g), 1)
        np.add.at(mark, hits + 1, -1)
        wanted |= np.cumsum(mark)[:-1] > 0
    starts = np.flatnonzero(wanted)
    if not len(starts):
        return []
    # texts are laid apart so that no window reads the next one
    gap = items.steps + 1
    new = np.zeros(total, bool)
    new[1:] = owner[1:] != owner[:-1]
    place = np.arange(total) + np.cumsum(new) * gap
    apart = np.zeros(place[-1] + gap + 1, np.uint64)
    apart[place] = batch_words
    found: dict[tuple[int, int], tuple[int, int, int]] = {}
    parts: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for lot in range(0, len(starts), 4096):
        some = starts[lot : lot + 4096]
        keys = items.keys(apart, place[some])
        pairs = []
        for b, (index, item) in items.index.items():
            own = keys[b].ravel()
            low, high = np.searchsorted(index, own, "left"), np.searchsorted(index, own, "right")
            many = high - low
            at = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            pairs.append(np.repeat(np.arange(len(own)) // items.repeats, many) * len(items.n) + item[at])
        pairs = np.unique(np.concatenate(pairs))
        window, item = pairs // len(items.n), pairs % len(items.n)
        for bit in range(0, len(pairs), 2048):
            w, k = window[bit : bit + 2048], item[bit : bit + 2048]
            width = int((items.n + items.edits)[k].max())
            spots = place[some[w]][:, None] + np.arange(width)
            texts = apart[np.minimum(spots, len(apart) - 1)]
            # beyond the item's own reach nothing may match
            distance, length = edit_distances(texts, items.padded[k][:, : int(items.n[k].max())], items.n[k])
            for j in np.flatnonzero(distance <= items.edits[k]):
                at = some[w[j]]
                key = (int(owner[at]), int(items.item[k[j]]))
                if items.n[k[j]] < len(items.whole[key[1]]):
                    spare, begin = int(items.whole_edits[key[1]]), int(at - items.at[k[j]])
                    parts.setdefault(key, []).append((begin - spare, begin + spare))
                    continue
                new_find = (int(distance[j]), int(at), int(length[j]))
                if key not in found or new_find[:2] < found[key][:2]:
                    found[key] = new_find
    for (t, k), ranges in parts.items():
        low, high = np.searchsorted(owner, [t, t + 1])
        within = [(max(0, a - int(low)), min(b, int(high) - 1) - int(low)) for a, b in ranges if b >= low]
        distance, at, length = nearest_place(batch_words[low:high], items.whole[k], within)
        if distance <= items.whole_edits[k]:
            found[t, k] = distance, int(low) + at, length
    first = np.searchsorted(owner, [t for t, _ in found])
    return [(t, k, at - int(f), n, d) for ((t, k), (d, at, n)), f in zip(found.items(), first)]


def _blocks(benchmark: DataFrame, block: int, **settings) -> Iterator[Items]:
    """The benchmark's items in blocks of about ``block`` rows."""
    rows = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")).filter("text is not null")
    n_blocks = max(1, -(-rows.count() // block))
    for k in range(n_blocks):
        lot = sorted(((r["item_id"], r["text"]) for r in rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == k).collect()), key=lambda i: (i[0] is None, i[0] or 0, i[1]))
        yield Items([i for i, _ in lot], [t for _, t in lot], **settings)


def _finds(batch: pa.RecordBatch, items: Items) -> list[tuple[int, int, int, int, int]]:
    words, owner = words_of(*flat(batch.column("text")))
    return find(words, owner, items) if len(words) and items.ids else []


def leaks(docs: DataFrame, benchmark: DataFrame, allowed: float = 0.2, min_words: int = 5, walks: int = 4, repeats: int = 64, block: int = 5000) -> DataFrame:
    """doc_id, item_id and the nearest place (word_start, n_words, distance, similarity) of every item found in a document."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    result = None
    for items in _blocks(benchmark, block, allowed=allowed, min_words=min_words, walks=walks, repeats=repeats):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = shared.value
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
            names = [c.split()[0] for c in FOUND.split(", ")]
            for batch in sliced(batches):
                ids = batch.column("doc_id").to_pylist()
                out = [(ids[t], items.ids[i], at, n, d, 1 - d / len(items.whole[i])) for t, i, at, n, d in _finds(batch, items)]
                yield pa.record_batch({c: pa.array([o[j] for o in out], t) for j, (c, t) in enumerate(zip(names, kinds))})

        part = docs.mapInArrow(run, FOUND)
        result = part if result is None else result.unionByName(part)
    return result


def clean(docs: DataFrame, benchmark: DataFrame, allowed: float = 0.2, min_words: int = 5, walks: int = 4, repeats: int = 64, block: int = 5000) -> DataFrame:
    """The documents, all columns unchanged, that hold no item."""
    bounded_batches(docs.sparkSession)
    for items in _blocks(benchmark, block, allowed=allowed, min_words=min_words, walks=walks, repeats=repeats):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in sliced(batches):
                keep = np.ones(batch.num_rows, bool)
                keep[[t for t, *_ in _finds(batch, shared.value)]] = False
                yield batch.filter(pa.array(keep, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
