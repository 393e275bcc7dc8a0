"""Document fingerprints from spot signatures.

A spot is a common word; in every text, every eighth word by hash and the first word
serve as well, so that texts with few common words (tables, other languages) have a
fingerprint too and no text changes its rule by an edit. Its signature is the
chain of the next content words after it, each ``distance`` content words from the last. The set of
a text's signatures is its fingerprint, compared by Jaccard likeness. A fingerprint is
text: base64 of the sorted 32-bit signature hashes.

Near duplicates (``near_pairs``, which no registered query runs) are found by partitions of set length: two sets of likeness t have
lengths within a factor t, so a set is only compared in its own partition and the next,
through the signatures in its prefix, and pairs whose lengths rule them out are dropped
before any set is opened.

Defined cases: a null text counts as empty; a text without words has an empty set, like
nothing but another empty set (likeness 1 of two empty sets). Equal texts have equal
fingerprints. Repeated rows follow each other as documents of their own. A null id sorts
before all others.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floe.llm.common import sliced
from floe.llm.rolling import mix, word_hashes, word_spans

#: common words of the supported languages
COMMON = (
    "the a an of to and in is was are be by for that this it with from on at as or "
    "der die das und den dem des ein eine einer ist zu von mit im auf für nicht auch "
    "le la les de des du un une et est pour dans que qui par sur pas avec en au "
    "el los las del y es por con para una uno se su lo como"
)


def _hash_words(words: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    return word_hashes(data, *word_spans(data))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CODE = np.arange(256)
_EDGE = (_CODE < 128) & ~np.isin(_CODE, list(b"0123456789abcdefghijklmnopqrstuvwxyz"))


class Spots:
    """Signature sets of texts: ``chain`` content words after each spot, ``distance`` apart."""

    def __init__(self, common: str = COMMON, chain: int = 2, distance: int = 1):
        self.common = np.unique(_hash_words(common.split()))
        self.chain, self.distance = chain, distance

    def signatures(self, text: bytes) -> np.ndarray:
        """Sorted distinct 32-bit signature hashes of a text in UTF-8."""
        data = _LOWER[np.frombuffer(text, np.uint8)]
        data = np.where(_EDGE[data], 32, data)  # punctuation parts words
        starts, ends = word_spans(data)
        if not len(starts):
            return np.zeros(0, np.uint32)
        words = word_hashes(data, starts, ends)
        at = np.minimum(np.searchsorted(self.common, words), len(self.common) - 1)
        spot = self.common[at] == words
        content = np.flatnonzero(~spot)
        # chosen by content alone, so that an edit elsewhere changes no spot
        spot |= words & np.uint64(7) == 0
        spot[0] = True
        spots = np.flatnonzero(spot)
        out = words[spots] * np.uint64(3)
        if len(content):
            first = np.searchsorted(content, spots, "right")
            padded = np.append(words[content], np.uint64(0))
            for k in range(self.chain):
                link = padded[np.minimum(first + k * self.distance, len(content))]
                out = mix(out + link)
        return np.unique((out >> np.uint64(32)).astype(np.uint32))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard likeness of two sorted sets; two empty ones are alike."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def encode(signatures: np.ndarray) -> str:
    return base64.b64encode(signatures.astype("<u4").tobytes()).decode()


def decode(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), "<u4")


def fingerprints(docs: DataFrame, spots: Spots | None = None) -> DataFrame:
    """doc_id and fingerprint of every whole text."""
    spots = spots or Spots()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            made = [encode(spots.signatures((t or "").encode())) for t in batch.column("text").to_pylist()]
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "fingerprint": pa.array(made, pa.string())})

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, fingerprint string")


def near_pairs(prints: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Pairs (a, b, likeness) of different fingerprints at or above the threshold; a and b are the smallest ids
    holding each. Equal fingerprints are one class and are not expanded into pairs.
    """
    classes = prints.filter("fingerprint <> ''").groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id"))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The prefix of a set under (length partition, signature): its own partition and the shorter neighbour's."""
        for batch in batches:
            ids, part, sig, size = [], [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("fingerprint").to_pylist()):
                s = np.sort(mix(decode(text).astype(np.uint64)))  # scattered order, the same for all
                n = len(s)
                prefix = s[: n - int(np.ceil(threshold * n - 1e-9)) + 1]
                own = int(np.log(n) / -np.log(threshold) + 1e-9)
                for p in (own, own - 1):
                    if p == own or np.log(n * threshold) / -np.log(threshold) < own:
                        ids += [doc_id] * len(prefix)
                        part += [p] * len(prefix)
                        sig += prefix.astype(np.int64).tolist()
                        size += [n] * len(prefix)
            yield pa.record_batch({"id": pa.array(ids, pa.int64()), "part": pa.array(part, pa.int32()), "sig": pa.array(sig, pa.int64()), "size": pa.array(size, pa.int32())})

    rows = classes.mapInArrow(keys, "id bigint, part int, sig bigint, size int")
    left, right = rows.select("part", "sig", F.col("id").alias("a"), F.col("size").alias("na")), rows.select("part", "sig", F.col("id").alias("b"), F.col("size").alias("nb"))
    fits = (F.col("a") < F.col("b")) & (F.least("na", "nb") >= threshold * F.greatest("na", "nb"))
    pairs = left.join(right, ["part", "sig"]).filter(fits).select("a", "b").distinct()
    side = lambda name: classes.select(F.col("doc_id").alias(name), F.col("fingerprint").alias(f"print_{name}"))
    opened = pairs.join(side("a"), "a").join(side("b"), "b")

    @F.pandas_udf("double")
    def jaccard(x, y):
        import pandas as pd

        return pd.Series([likeness(decode(p), decode(q)) for p, q in zip(x, y)], dtype=float)

    return opened.select("a", "b", jaccard("print_a", "print_b").alias("likeness")).filter(F.col("likeness") >= threshold)


def with_next(docs: DataFrame, texts_per_bucket: int = 4000) -> DataFrame:
    """Every text in id order with the one after it, streamed: ``bucket`` runs of compressed texts.

    Buckets are ranges of ids. Each range begins at an id that occurs, and the rows with
    that id go to the range before as well, marked as its end, so that no neighbour is missing.
    """
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    total = ids.count()
    parts = max(1, total // texts_per_bucket)
    cuts = ids.approxQuantile("doc_id", [k / parts for k in range(parts)], 1 / (4 * parts)) if total else []
    low = ids.agg(F.min("doc_id")).first()[0]
    borders = np.array(sorted({int(c) for c in cuts} | ({low} if low is not None else set())), np.int64)
    if not len(borders):
        borders = np.zeros(1, np.int64)
    last = len(borders) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            out = {"bucket": [], "tail": [], "doc_id": [], "tie": [], "packed": []}
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                raw = (text or "").encode()
                packed, tie = zlib.compress(raw, 1), hashlib.sha1(raw).digest()
                k = 0 if doc_id is None else max(0, int(np.searchsorted(borders, doc_id, "right")) - 1)
                rows = [(k, 0)]
                if doc_id is None or doc_id == borders[k]:
                    rows.append((k - 1, 1) if k else (last, 1))
                for bucket, tail in rows:
                    for name, value in zip(out, (bucket, tail, doc_id, tie, packed)):
                        out[name].append(value)
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
            yield pa.record_batch({n: pa.array(v, t) for (n, v), t in zip(out.items(), kinds)})

    rows = ids.mapInArrow(run, "bucket int, tail int, doc_id bigint, tie binary, packed binary")
    return rows.repartition(max(1, len(borders)), "bucket").sortWithinPartitions("bucket", "tail", F.asc_nulls_first("doc_id"), "tie")


def compare_edits(docs: DataFrame, spots: Spots | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text (the last quarter replaced by the beginning of the next
    document), with the likeness of the text to its edit and to the next document.
    """
    spots = spots or Spots()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row that waits for its successor
        ended = None  # a bucket whose first tail row has been used

        def finish(row, following) -> tuple:
            doc_id, text, own = row
            quarter = len(text) // 4
            edited = text[: len(text) - quarter] + following[1][:quarter]
            other = spots.signatures(edited.encode()) if edited != text else own
            return (doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), encode(own), encode(other), likeness(own, other), likeness(own, following[2]))

        names = "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next".split()
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
        bucket_of_held = None
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                done = []
                for row in whole.slice(start, 512).to_pylist():
                    if row["tail"] and ended == row["bucket"]:
                        continue
                    text = zlib.decompress(row["packed"]).decode()
                    now = (row["doc_id"], text, spots.signatures(text.encode()))
                    if held is not None and bucket_of_held == row["bucket"]:
                        done.append(finish(held, now))
                    held, bucket_of_held = now, row["bucket"]
                    if row["tail"]:
                        ended, held = row["bucket"], None
                yield pa.record_batch({n: pa.array([d[k] for d in done], t) for k, (n, t) in enumerate(zip(names, kinds))})

    return with_next(docs).mapInArrow(run, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
