"""Language identification by prediction by partial matching over bytes.

Each language has a tree of byte contexts up to three bytes long. The probability of
a byte in a context is its count over the count of all bytes there plus the number of
different ones; what is left is the escape to the next shorter context. Statistics are
frozen after training, so the code length of a text is a sum of table entries.

Defined cases: a null text, or one without any letter, gives ``und`` with score 0, as
does everything where no training row exists. Repeated rows are scored alike. Further
columns of the input are neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floe.llm.common import bounded_batches, flat, held_out, sliced

ORDER = 3
#: symbol 0 stands for bytes never seen in training, 1 for what lies before a text
FIRST = 2
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


def _grams(symbols: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The symbols one, two and three places before each position, within its own text."""
    place = np.arange(len(symbols)) - np.repeat(offsets[:-1], np.diff(offsets))
    back = []
    for k in range(1, ORDER + 1):
        before = np.ones_like(symbols)
        before[k:] = symbols[:-k]
        before[place < k] = 1
        back.append(before)
    return back


def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n): counts of a byte after its three predecessors; each as byte + 1, 0 before a text."""
    for batch in sliced(batches):
        langs = np.array(batch.column("lang").to_pylist(), object)
        data, offsets = flat(batch.column("text"))
        if not len(data):
            continue
        wide = data.astype(np.int64) + FIRST
        first, second, third = _grams(wide, offsets)
        gram = ((third * 258 + second) * 258 + first) * 258 + wide
        owner = np.repeat(langs, np.diff(offsets))
        for lang in dict.fromkeys(langs):
            values, counts = np.unique(gram[owner == lang], return_counts=True)
            yield pa.record_batch({"lang": pa.array([lang] * len(values), pa.string()), "gram": pa.array(values, pa.int64()), "n": pa.array(counts, pa.int64())})


def training_rows(docs: DataFrame, per_language: int) -> DataFrame:
    """At most about ``per_language`` whole texts of each language outside the evaluation fold, chosen by hash of the id."""
    rows = docs.select("doc_id", "text", "lang").filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    shares = {r["lang"]: per_language / max(1, r["n"]) for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not shares:
        return rows.limit(0)
    share = F.create_map(*[F.lit(x) for pair in shares.items() for x in pair])[F.col("lang")]
    return rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share * 1_000_000).select("lang", "text")


class ContextTree:
    """Frozen code lengths (bits) of every byte in every kept context, for all languages side by side."""

    def __init__(self, langs: np.ndarray, grams: np.ndarray, counts: np.ndarray, max_contexts: int):
        self.langs = sorted(set(langs.tolist()))
        lang = np.searchsorted(np.array(self.langs, object), langs) if len(langs) else np.zeros(0, np.int64)
        parts = [grams // 258**k % 258 for k in range(ORDER + 1)]
        seen = np.unique(np.concatenate(parts))
        symbol = np.zeros(258, np.int64)
        symbol[1] = 1
        symbol[seen[seen >= FIRST]] = np.arange(FIRST, FIRST + (seen >= FIRST).sum())
        self.byte = symbol[FIRST:]  # byte value to symbol
        self.size = size = int(symbol.max()) + 1
        now, *back = (symbol[p] for p in parts)
        bits, row_of, context, rows = np.full((1, size, len(self.langs)), np.log2(size), np.float32), np.zeros(1, np.int64), np.zeros_like(now), []
        for order in range(ORDER + 1):
            if order:
                context = context + back[order - 1] * size ** (order - 1)
            names, index = np.unique(context, return_inverse=True)
            kept = np.sort(np.argsort(-np.bincount(index, counts, len(names)), kind="stable")[:max_contexts])
            place = np.full(len(names), -1)
            place[kept] = np.arange(len(kept))
            index, names = place[index], names[kept]
            ok = index >= 0
            n = np.zeros((len(names), size, len(self.langs)), np.float32)
            np.add.at(n, (index[ok], now[ok], lang[ok]), counts[ok])
            shorter = bits[row_of[names % max(1, size ** (order - 1))]] if order else np.repeat(bits, len(names), 0)
            total, distinct = n.sum(1, keepdims=True), (n > 0).sum(1, keepdims=True)
            with np.errstate(divide="ignore", invalid="ignore"):
                known = np.where(n > 0, np.log2((total + distinct) / n), np.log2((total + distinct) / distinct) + shorter)
            rows.append(np.where(total > 0, known, shorter))  # a language without the context goes on without an escape
            # a context that is not kept is answered by its longest kept ending
            row_of = np.tile(row_of, size if order else 1)
            row_of[names] = (sum(len(r) for r in rows[:-1])) + np.arange(len(names))
            bits = np.concatenate(rows)
        self.bits = np.ascontiguousarray(bits.reshape(bits.shape[0] * size, len(self.langs)), np.float32)
        self.row_of = row_of.astype(np.int32)

    def lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Code length of every text in every language."""
        out = np.zeros((len(offsets) - 1, len(self.langs)))
        full = np.flatnonzero(np.diff(offsets))
        if not len(full):
            return out
        symbols = self.byte[data]
        first, second, third = _grams(symbols, offsets)
        row = self.row_of[(third * self.size + second) * self.size + first]
        out[full] = np.add.reduceat(self.bits[row.astype(np.int64) * self.size + symbols], offsets[full], axis=0, dtype=np.float64)
        return out


def fit(docs: DataFrame, per_language: int = 1000, max_contexts: int = 4_000) -> ContextTree:
    """Train on a bounded sample (``per_language``) of the rows outside the evaluation fold.

    ``max_contexts`` bounds the contexts kept per order, the most frequent first.
    """
    bounded_batches(docs.sparkSession)
    rows = training_rows(docs, per_language)
    grams = rows.mapInArrow(count_grams, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    return ContextTree(grams["lang"].to_numpy(object), grams["gram"].to_numpy(np.int64), grams["n"].to_numpy(np.float64), max_contexts)


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each text holds a letter of any script."""
    out = np.zeros(len(offsets) - 1, bool)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        out[full] = np.logical_or.reduceat(_LETTER[data], offsets[full])
    for i in full[~out[full]]:
        out[i] = any(c.isalpha() for c in data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace"))
    return out


def judge(tree: ContextTree, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Language and score of every text."""
    known = has_letter(data, offsets) & bool(tree.langs)
    names, share = np.full(len(known), "und", object), np.zeros(len(known))
    if known.any():
        bits = tree.lengths(data, offsets)
        odds = np.exp2(np.maximum(bits.min(1, keepdims=True) - bits, -1000)).sum(1)
        names[known] = np.array(tree.langs, object)[bits.argmin(1)[known]]
        share[known] = 1 / odds[known]
    return names, share


def accepted(docs: DataFrame, tree: ContextTree, least: float = 0.5) -> DataFrame:
    """The documents, all columns unchanged, whose language is known with a score of at least ``least``."""
    model = docs.sparkSession.sparkContext.broadcast(tree)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            names, share = judge(model.value, *flat(batch.column("text")))
            yield batch.filter(pa.array((names != "und") & (share >= least), pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def identify(docs: DataFrame, tree: ContextTree) -> DataFrame:
    """doc_id, lang_pred and score (share of the best language among all, from the code lengths)."""
    model = docs.sparkSession.sparkContext.broadcast(tree)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            names, share = judge(model.value, *flat(batch.column("text")))
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "lang_pred": pa.array(names, pa.string()), "score": pa.array(share)})

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text")).mapInArrow(score, "doc_id bigint, lang_pred string, score double")
