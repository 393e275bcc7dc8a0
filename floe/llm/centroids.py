"""Lloyd's algorithm over column blocks of exact integer vectors.

The vectors are cut into chunks of rows and each chunk into shards of columns; a stored row is
one (chunk, shard) block. A round has two steps:

1. each block's task computes exact squared distances over its own columns to its own slice of
   the centroids; the blocks of a chunk are reduced by key: partial distances are added, the
   nearest centroid is taken (ties: smaller number), and the block columns that came along are
   summed up for it. Tasks add up what they have reduced, so a round returns one row a task
   and shard, whatever the number of vectors;
2. each shard updates its own slice: floor(sum / count); a centroid without vectors stays.

Only centroids (k x columns numbers, fixed by the parameters) reach the driver. Chunks are
cut by position, so repeated ids and repeated vectors gather nowhere.

Arithmetic is exact: blocks are multiplied as doubles while every intermediate stays below
2^53, and as Python integers beyond.

Defined cases: vectors that are null, of another length, or hold a null or non-finite component
are left out; an empty table gives no rows; with fewer than k vectors there are fewer centroids;
of equal start hashes (repeated or null ids, null last) the smaller vector comes first;
distances or sums beyond a long are returned as null. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from floe.llm.common import free, stored

CHUNK = 1024
EXACT = 1 << 53


def packed(values: np.ndarray) -> bytes:
    """Whole numbers as bytes: the narrowest width that holds them, decimal text beyond 64 bits."""
    if values.dtype == object:
        return b"t" + ",".join(str(int(v)) for v in values.ravel()).encode()
    top = int(np.abs(values).max()) if values.size else 0
    code = b"h" if top < 1 << 15 else b"i" if top < 1 << 31 else b"q"
    return code + values.astype({b"h": "<i2", b"i": "<i4", b"q": "<i8"}[code]).tobytes()


def opened(raw: bytes, columns: int) -> np.ndarray:
    """The matrix that was packed."""
    if raw[:1] == b"t":
        out = np.array([int(v) for v in raw[1:].split(b",")] if len(raw) > 1 else [], object)
    else:
        out = np.frombuffer(raw, {b"h": "<i2", b"i": "<i4", b"q": "<i8"}[raw[:1]], offset=1).astype(np.int64)
    return out.reshape(-1, columns)


def _largest(values: np.ndarray) -> int:
    return max((abs(int(values.max())), abs(int(values.min())))) if values.size else 0


def narrowed(values: np.ndarray) -> np.ndarray:
    """64-bit where all numbers fit, Python integers otherwise."""
    return values.astype(np.int64) if values.dtype == object and _largest(values) < 1 << 62 else values


def distances(block: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows to all centroids."""
    if 4 * block.shape[1] * max(_largest(block), _largest(centres)) ** 2 < EXACT:
        x, c = block.astype(np.float64), centres.astype(np.float64)
        return ((x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)).astype(np.int64)
    x, c = block.astype(object), centres.astype(object)
    return np.stack([((x - row) ** 2).sum(1) for row in c], 1)


def whole_numbers(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as integers."""
    scaled = np.floor(scale * vectors)
    if not scaled.size or np.abs(scaled).max() < EXACT:
        return scaled.astype(np.int64)
    from fractions import Fraction
    from math import floor

    return np.array([[floor(scale * Fraction(float(v))) for v in row] for row in vectors], object).reshape(vectors.shape)


def _kept(vectors: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows whose vector counts, and their components."""
    values = vectors.flatten()
    length = pc.list_value_length(vectors).fill_null(0).to_numpy(zero_copy_only=False)
    begin = np.cumsum(length) - length
    rows = np.flatnonzero(length == size)
    flat = values.to_numpy(zero_copy_only=False).astype(np.float64) if len(values) else np.zeros(0)  # null becomes NaN
    taken = flat[begin[rows][:, None] + np.arange(size)] if len(rows) else np.zeros((0, size))
    fine = np.isfinite(taken).all(1)
    return rows[fine], taken[fine]


def _blocks(size: int, shards: int, scale: int, chunk: int):
    """Blocks of columns; shard -1 holds the ids of the chunk."""
    edges = [size * s // shards for s in range(shards + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        ids, vectors = [], []

        def flush() -> pa.RecordBatch:
            nonlocal number, ids, vectors
            whole = whole_numbers(np.concatenate(vectors), scale)
            key = (task << 32) + number
            number += 1
            blocks = [packed(narrowed(whole[:, a:b])) for a, b in zip(edges, edges[1:])]
            out = pa.record_batch({
                "chunk": pa.array([key] * (shards + 1), pa.int64()), "shard": pa.array(range(-1, shards), pa.int32()), "rows": pa.array([len(whole)] * (shards + 1), pa.int32()),
                "block": pa.array([None, *blocks], pa.binary()), "ids": pa.array([pa.concat_arrays(ids).to_pylist(), *[None] * shards], pa.list_(pa.int64())),
            })
            ids, vectors = [], []
            return out

        held = 0
        for batch in batches:
            for start in range(0, batch.num_rows, chunk):
                part = batch.slice(start, chunk)
                rows, taken = _kept(part.column("embedding"), size)
                names = part.column("vec_id").take(pa.array(rows))
                while len(taken):
                    room = chunk - held
                    ids.append(names[:room])
                    vectors.append(taken[:room])
                    held += len(taken[:room])
                    names, taken = names[room:], taken[room:]
                    if held == chunk:
                        yield flush()
                        held = 0
        if held:
            yield flush()

    return run


def _partial(slices: dict[int, bytes], widths: list[int]):
    """The distances of each block over its own columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(whole.num_rows):
                batch = whole.slice(i, 1)
                shard, raw = batch.column("shard")[0].as_py(), batch.column("block")[0].as_py()
                found = distances(opened(raw, widths[shard]), opened(slices[shard], widths[shard]))
                yield pa.record_batch({"chunk": batch.column("chunk"), "shard": batch.column("shard"), "block": batch.column("block"), "partial": pa.array([packed(narrowed(found))], pa.binary())})

    return run


def _nearest(partials: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Partial distances added; the nearest centroid of each row and its distance."""
    total = sum((opened(p, k).astype(object) if p[:1] == b"t" else opened(p, k) for p in partials[1:]), opened(partials[0], k))
    nearest = total.argmin(1)
    return nearest, total[np.arange(len(total)), nearest]


def _reduced(k: int, widths: list[int]):
    """Of each chunk its columns' sums by nearest centroid, a shard each."""

    def run(key, table):
        shards, blocks, partials = (table.column(c).to_pylist() for c in ("shard", "block", "partial"))
        nearest, _ = _nearest(partials, k)
        one = np.zeros((k, len(nearest)), np.int64)
        one[nearest, np.arange(len(nearest))] = 1
        sums = []
        for shard, raw in zip(shards, blocks):
            block = opened(raw, widths[shard])
            if block.dtype != object and _largest(block) * len(block) < EXACT:
                sums.append(packed((one.astype(np.float64) @ block.astype(np.float64)).astype(np.int64)))
            else:
                sums.append(packed(one.astype(object) @ block.astype(object)))
        return pa.table({"shard": pa.array(shards, pa.int32()), "sums": pa.array(sums, pa.binary()), "counts": pa.array([one.sum(1)] * len(shards), pa.list_(pa.int64()))})

    return run


def _added(widths: list[int]):
    """A task's sums, one row a shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            for shard, raw, count in zip(*(batch.column(c).to_pylist() for c in ("shard", "sums", "counts"))):
                more = opened(raw, widths[shard])
                mine = sums.get(shard)
                if mine is not None and (more.dtype == object or mine.dtype == object or _largest(mine) + _largest(more) >= 1 << 62):
                    mine, more = mine.astype(object), more.astype(object)
                sums[shard] = more if mine is None else mine + more
                counts[shard] = np.array(count) + counts.get(shard, 0)
        if sums:
            keys = sorted(sums)
            yield pa.record_batch({"shard": pa.array(keys, pa.int32()), "sums": pa.array([packed(sums[s]) for s in keys], pa.binary()), "counts": pa.array([counts[s] for s in keys], pa.list_(pa.int64()))})

    return run


def _updated(slices: dict[int, bytes], widths: list[int]):
    """A shard's new slice from its sums."""

    def run(key, table):
        shard = key[0].as_py()
        centres = opened(slices[shard], widths[shard]).astype(object)
        sums = sum(opened(raw, widths[shard]).astype(object) for raw in table.column("sums").to_pylist())
        counts = np.array(table.column("counts").to_pylist(), object).sum(0)
        for c in np.flatnonzero(counts):
            centres[c] = sums[c] // int(counts[c])  # floor, for negative sums too
        return pa.table({"shard": pa.array([shard], pa.int32()), "slice": pa.array([packed(narrowed(centres))], pa.binary())})

    return run


def _assigned(k: int):
    """Of each chunk the nearest centroid and distance of every row, with the row's id."""

    def run(key, table):
        raw, ids = table.column("partial").to_pylist(), table.column("ids").to_pylist()
        nearest, distance = _nearest([p for p in raw if p is not None], k)
        inside = [int(d) if d < 1 << 63 else None for d in distance] if distance.dtype == object else distance
        return pa.table({"vec_id": pa.array(next(i for i in ids if i is not None), pa.int64()), "cluster": pa.array(nearest, pa.int32()), "distance": pa.array(inside, pa.int64())})

    return run


def starts(vectors: DataFrame, k: int, seed: int, size: int) -> np.ndarray:
    """The k vectors whose ids' hashes are smallest: a top-k, k is a parameter."""
    sound = F.expr(f"size(embedding) = {size} and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('inf'))")
    named = vectors.filter(F.coalesce(sound, F.lit(False))).withColumn("_order", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256))
    first = named.orderBy(F.asc_nulls_last("_order"), "embedding").limit(k).select("embedding").collect()
    return np.array([r[0] for r in first], np.float64).reshape(-1, size)


def lloyd(vectors: DataFrame, k: int = 40, rounds: int = 5, size: int = 64, scale: int = 256, seed: int = 2, shards: int = 4, chunk: int = CHUNK) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every vector that counts, and the final centroids."""
    spark = vectors.sparkSession
    vectors = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    centres = whole_numbers(starts(vectors, k, seed, size), scale)
    k = len(centres)
    if not k:
        return spark.createDataFrame([], "vec_id bigint, cluster int, distance bigint"), centres
    edges = [size * s // shards for s in range(shards + 1)]
    widths = [b - a for a, b in zip(edges, edges[1:])]
    blocks = stored(vectors.mapInArrow(_blocks(size, shards, scale, chunk), "chunk bigint, shard int, rows int, block binary, ids array<bigint>"), "blocks")
    slices = {s: packed(narrowed(centres[:, a:b])) for s, (a, b) in enumerate(zip(edges, edges[1:]))}
    columns = blocks.filter("shard >= 0").select("chunk", "shard", "block")
    for _ in range(rounds):
        partial = columns.mapInArrow(_partial(slices, widths), "chunk bigint, shard int, block binary, partial binary")
        sums = partial.groupBy("chunk").applyInArrow(_reduced(k, widths), "shard int, sums binary, counts array<bigint>")
        sums = sums.mapInArrow(_added(widths), "shard int, sums binary, counts array<bigint>")
        slices |= {r["shard"]: bytes(r["slice"]) for r in sums.groupBy("shard").applyInArrow(_updated(slices, widths), "shard int, slice binary").collect()}
        free(spark)
    partial = columns.mapInArrow(_partial(slices, widths), "chunk bigint, shard int, block binary, partial binary")
    named = blocks.filter("shard < 0").select("chunk", "ids", F.lit(None).cast("binary").alias("partial"))
    both = partial.select("chunk", F.lit(None).cast("array<bigint>").alias("ids"), "partial").unionByName(named)
    found = stored(both.groupBy("chunk").applyInArrow(_assigned(k), "vec_id bigint, cluster int, distance bigint"), "assigned")
    return found, np.concatenate([opened(slices[s], w) for s, w in enumerate(widths)], 1)


def clustered(vectors: DataFrame, k: int = 40, rounds: int = 5, **options) -> DataFrame:
    """Cluster, distance, inertia and the hash of the final centroid of every vector that counts."""
    found, centres = lloyd(vectors, k, rounds, **options)
    spark = vectors.sparkSession
    names = [(c, hashlib.sha256(",".join(str(int(v)) for v in row).encode()).hexdigest()) for c, row in enumerate(centres)]
    names = spark.createDataFrame(names, "cluster int, centroid_sha256 string")
    each = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"), F.count(F.when(F.col("distance").isNull(), 1)).alias("open"))
    # a long, or null where a distance or the sum is beyond it
    long = lambda total, unknown: F.expr(f"try_cast(case when {unknown} = 0 then {total} end as bigint)")
    whole = Window.partitionBy()  # over one row a centroid
    sums = each.select("cluster", "s", "open", F.sum("s").over(whole).alias("all_s"), F.sum("open").over(whole).alias("all_open"))
    sums = sums.select("cluster", long("s", "open").alias("cluster_inertia"), long("all_s", "all_open").alias("inertia"))
    # one row a centroid on the small side
    return found.join(F.broadcast(sums.join(names, "cluster")), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
