"""Packing token sequences by cutting-stock column generation.

Every document is cut into full sequences and one rest. The rests are a cutting-stock
problem over their lengths: a linear programme over patterns (multisets of lengths that
fit one sequence) is grown column by column, a knapsack by dynamic programming finding
the pattern worth most at the current prices. Patterns are rounded down to whole counts,
what is left is filled longest first, and ranked rests are dealt to the pattern's slots.

Only the histogram of rest lengths (at most ``capacity`` numbers) and the patterns reach
the driver; ranks are counted per length and bucket, so no length is one group.

Defined cases: a null text is empty and holds only the end id; repeated rows are packed
each on its own; an empty table gives no piece.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from floe.llm.common import bounded_batches, sliced, stored

#: how byte-level BPE of this vocabulary splits text before merging (a fixed value of the format)
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
#: texts with other characters go to the tokenizer itself, whose character tables may be of another edition
_PLAIN = re.compile("[\x00-\x1b\x20-\u024f\u2010-\u2027]*")
TRIED = 50


def default_tokenizer() -> str:
    """Where the vocabulary of the contract lies."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones stand for themselves."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Ids:
    """Ids of texts as little-endian 32-bit bytes.

    Texts are merged by a second, faster library over the same vocabulary, taken from the
    tokenizer itself. A worker's first ``TRIED`` texts are encoded by both, and any
    difference leaves the tokenizer alone in charge.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.tried, self.merge = 0, None
        byte = _byte_of()
        vocabulary = {t: i for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if t not in self.special}
        if all(c in byte for t in vocabulary for c in t):
            import tiktoken

            ranks = {bytes(byte[c] for c in t): i for t, i in vocabulary.items()}
            self.merge = tiktoken.Encoding("bytes", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_to_numpy

    def _exact(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def of(self, text: str) -> bytes:
        """Ids of a whole text."""
        if self.merge is None or _PLAIN.fullmatch(text) is None or any(s in text for s in self.special):
            return self._exact(text)
        packed = self.merge(text).astype("<u4").tobytes()
        if self.tried < TRIED:
            self.tried += 1
            exact = self._exact(text)
            if exact != packed:
                self.merge = None
                return exact
        return packed


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 1024) -> DataFrame:
    """doc_id, start, length, ids (little-endian 32-bit), doc_tokens: each document and its end id 0 cut at ``capacity``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Ids(tokenizer_path)
        for batch in sliced(batches, limit=1 << 22):
            rows = {"doc_id": [], "start": [], "length": [], "ids": [], "doc_tokens": []}
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = memo.of(text or "") + b"\0\0\0\0"
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    part = ids[4 * start : 4 * (start + capacity)]
                    for name, value in zip(rows, (doc_id, start, len(part) // 4, part, total)):
                        rows[name].append(value)
            yield pa.record_batch({k: pa.array(v, pa.binary() if k == "ids" else pa.int64()) for k, v in rows.items()})

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint")


def knapsacks(values: np.ndarray, lengths: np.ndarray, capacity: int, many: int) -> list[np.ndarray]:
    """The best multisets of lengths within the capacity, each built around another length: counts per length."""
    best = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    order = np.argsort(-lengths)
    sizes, worth = lengths[order], values[order]
    fits = np.searchsorted(-sizes, -np.arange(capacity + 1))  # the first length that fits a room
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        k = fits[room]
        if k < len(sizes):
            gain = worth[k:] + best[room - sizes[k:]]
            top = gain.argmax()
            if gain[top] > best[room] + 1e-12:
                best[room], choice[room] = gain[top], k + top
    around = worth + best[capacity - sizes]
    found = []
    for k in np.argsort(-around)[:many]:
        if around[k] <= 1 + 1e-7:
            break
        counts, room = np.zeros(len(lengths), np.int64), capacity - sizes[k]
        counts[order[k]] = 1
        while room > 0:
            if choice[room] < 0:
                room -= 1
            else:
                counts[order[choice[room]]] += 1
                room -= sizes[choice[room]]
        found.append(counts)
    return found


def patterns(demand: np.ndarray, lengths: np.ndarray, capacity: int, rounds: int = 60, many: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (rows of counts per length) and how often the relaxed programme uses each.

    Revised simplex: the basis starts with the patterns of filling longest first (each
    uses up one length, so they are independent), its prices value the knapsack, found
    patterns enter while they still pay and the one that runs out first leaves.
    ``rounds`` and ``many`` bound the columns; the solution is feasible after every step.
    """
    m = len(lengths)
    basis, x, left, open_ = np.zeros((m, m)), np.zeros(m), demand.astype(float), np.ones(m, bool)
    for k in range(m):
        room, row = capacity, np.zeros(m)
        for i in np.flatnonzero(open_)[::-1]:
            if lengths[i] <= room:
                row[i] = min(room // lengths[i], max(1.0, np.ceil(left[i] - 1e-9)))
                room -= int(row[i]) * lengths[i]
                if room < lengths[0]:
                    break
        used = np.flatnonzero(row)
        times = (left[used] / row[used]).min()
        gone = used[(left[used] / row[used]).argmin()]
        basis[:, k], x[k] = row, times
        left = np.maximum(left - times * row, 0)
        left[gone], open_[gone] = 0, False
    inverse = np.linalg.inv(basis)
    x = np.maximum(inverse @ demand, 0)
    for _ in range(rounds):
        columns = knapsacks(np.maximum(inverse.sum(0), 0), lengths, capacity, many)
        moved = 0.0
        for column in columns:
            if inverse.sum(0) @ column <= 1 + 1e-7:
                continue
            change = inverse @ column
            ratio = np.full(len(x), np.inf)
            up = change > 1e-9
            ratio[up] = x[up] / change[up]
            out = int(ratio.argmin())
            moved += ratio[out]
            x = np.maximum(x - ratio[out] * change, 0)
            x[out] = ratio[out]
            basis[:, out] = column
            row = inverse[out] / change[out]
            inverse -= np.outer(change, row)
            inverse[out] = row
        if not columns or x.sum() * capacity <= demand @ lengths * (1 + 1e-4):
            break  # no pattern pays, or no room is left to gain
    return np.rint(basis).astype(np.int64).T, x


def stock_plan(demand: np.ndarray, lengths: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """(counts per length, how many sequences) that hold exactly the demand: rounded patterns, then the rest longest first."""
    plan: list[tuple[np.ndarray, int]] = []
    left = demand.astype(np.int64).copy()
    if not len(lengths):
        return plan
    rows, use = patterns(demand.astype(float), lengths, capacity)
    for row, times in sorted(zip(rows, np.floor(use + 1e-9).astype(np.int64)), key=lambda p: -p[1]):
        used = row > 0
        times = min(int(times), int((left[used] // row[used]).min())) if used.any() else 0
        if times > 0:
            plan.append((row, times))
            left -= row * times
    order = np.argsort(-lengths)
    while left.any():
        row, room = np.zeros_like(left), capacity
        for k in order:
            n = min(int(left[k] - row[k]), room // int(lengths[k]))
            if n > 0:
                row[k] += n
                room -= n * int(lengths[k])
        used = row > 0
        times = int((left[used] // row[used]).min())
        plan.append((row, times))
        left -= row * times
    return plan


def assign(cut: DataFrame, capacity: int = 1024, rows_per_bucket: int = 500_000) -> DataFrame:
    """``cut`` (doc_id, start, length and any further columns) with sequence_id and offset.

    Full pieces are sequences of their own, numbered after those of the rests. Each length
    has a bucket for every ``rows_per_bucket`` of its pieces, so no group grows with the table.
    """
    spark = cut.sparkSession
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    lengths = np.array(sorted(k for k in counts if k < capacity), np.int64)
    plan = stock_plan(np.array([counts[k] for k in lengths], np.int64), lengths, capacity)
    # slots: the ranks [low, low + times * many) of a length go to `times` sequences from `base`, `many` in each
    slots, taken, base = [], dict.fromkeys(lengths.tolist(), 0), 0
    for row, times in plan:
        room = 0
        for k in np.flatnonzero(row)[::-1]:
            size, many = int(lengths[k]), int(row[k])
            slots.append((size, taken[size], taken[size] + times * many, base, many, room))
            taken[size] += times * many
            room += many * size
        base += times
    if capacity in counts:
        slots.append((capacity, 0, counts[capacity], base, 1, 0))
    by_length: dict[int, list[tuple]] = {}
    for size, low, high, first, many, room in slots:
        by_length.setdefault(size, []).append((low, high, first, many, room))
    table = spark.sparkContext.broadcast({k: np.array(v, np.int64) for k, v in by_length.items()})

    # rank of a piece among its length: its bucket's first rank plus its place in the bucket
    many = {k: n // rows_per_bucket for k, n in counts.items() if n >= 2 * rows_per_bucket}
    buckets = F.coalesce(F.create_map(*(F.lit(int(x)) for pair in many.items() for x in pair))[F.col("length").cast("int")], F.lit(1)) if many else F.lit(1)
    cut = cut.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "start"), buckets).cast("int"))
    sizes = cut.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
    firsts = sizes.withColumn("_first", F.sum("_n").over(Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)))
    firsts = firsts.select("length", "_bucket", F.coalesce("_first", F.lit(0)).alias("_first"))
    placed = cut.withColumn("_place", F.row_number().over(Window.partitionBy("length", "_bucket").orderBy("doc_id", "start")) - 1)
    ranked = placed.join(firsts, ["length", "_bucket"]).withColumn("_rank", F.col("_first") + F.col("_place"))
    outer = [c for c in cut.columns if not c.startswith("_")]

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def seat(length, rank):
        import pandas as pd

        seq, off = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        size, rank = length.to_numpy(), rank.to_numpy()
        for k in np.unique(size):
            at = np.flatnonzero(size == k)
            low, high, first, many, room = table.value[int(k)].T
            r = rank[at]
            j = np.searchsorted(high, r, "right")
            seq[at] = first[j] + (r - low[j]) // many[j]
            off[at] = room[j] + (r - low[j]) % many[j] * k
        return pd.DataFrame({"sequence_id": seq, "offset": off})

    return ranked.withColumn("_seat", seat("length", "_rank")).select(*outer, "_seat.sequence_id", "_seat.offset")


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 1024) -> DataFrame:
    """doc_id, start, length, ids, doc_tokens, sequence_id, offset for every piece; the ids are tokenized once and stored.

    The ids are dealt out with their pieces, so a group is kept at about 4 MB of ids.
    """
    bounded_batches(docs.sparkSession)
    return assign(stored(pieces(docs, tokenizer_path, capacity), "pieces"), capacity, rows_per_bucket=max(1, (1 << 20) // capacity))
