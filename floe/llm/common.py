"""Small helpers shared by the operators: flat text, sliced batches, stored tables, components."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from floe.session import shared_dir

SLICE_BYTES = 1 << 20
BATCH_BYTES = 4 << 20


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the folder that all executors share."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def bounded_batches(spark: SparkSession, limit: int = BATCH_BYTES) -> None:
    """Let the JVM cut Arrow batches by bytes, so that wide rows do not fill a worker: a batch holds at most ``limit`` or one row."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(name).rstrip("b")) not in range(1, limit + 1):
        spark.conf.set(name, str(limit))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: a lost executor never recomputes it."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free(spark: SparkSession, *tables: DataFrame) -> None:
    """Remove stored tables that nothing reads any more, and let Spark drop the shuffle files of finished jobs."""
    for table in tables:
        path = spark._jvm.org.apache.hadoop.fs.Path(table.inputFiles()[0]).getParent() if table.inputFiles() else None
        if path is not None:
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    spark._jvm.System.gc()


def held_out(doc_id: Column) -> Column:
    """The evaluation fold: crc32 of the id as text leaves remainder 2 by 4 (false for a missing id)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 (or binary) bytes of a column and the offset of each value; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string()
    if column.null_count:
        column = column.fill_null(b"" if wide == pa.large_binary() else "")
    column = column.cast(wide)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def trim() -> None:
    """Give freed memory back to the system, where the C library can: workers stay and are used again."""
    give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if give_back is not None:
        give_back(0)
    pa.default_memory_pool().release_unused()


def sliced(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of one hold about ``limit`` bytes; one longer text stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = flat(batch.column(column))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop
    trim()


def lists(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list column from flat values and the length of each list."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected links (a, b): (node, component) of all but the smallest node, which names each.

    Large-star and small-star steps in turn: every step is a minimum per node and an
    equi-join, a hub costs one row per link, and the rounds grow with the logarithm
    of the longest chain. Each round is written to the shared folder.
    """
    edges = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.join(low, "u").filter("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        edges = stored(small, "links")
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if now == before:
            return edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
        before = now
