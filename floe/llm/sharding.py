"""Global shuffle of a table into shards in two passes, with built-in functions only.

1. Scatter: a seeded hash of each row's place in the input names its bucket. It looks at no
   column, so neither a hot key nor a group of copies (equal texts) gathers anywhere, and
   the buckets are as large as one task's memory allows (``bucket_bytes``). This is the only
   exchange of the data; bucket and partition are the same.
2. Every bucket is brought into hash order, shuffled by Fisher-Yates (``shuffle`` with a
   seed) and written to the shared folder.

Bucket after bucket, the written rows are one random order of the table. Shards are equal
stretches of it: with n rows and s shards the first n mod s shards hold one row more (law
``rows``: counts are at most one apart). Where the stretches begin follows from the number
of rows of each bucket, read from what was written, so a repeated task changes nothing.

Defined cases: an empty table gives no rows; with fewer rows than shards the first shards hold
one row each; null texts or ids, empty texts and repeated rows are rows as any other; a text
larger than a bucket stays whole and makes its bucket larger. All columns travel inside one
struct, so their names never clash. The order depends on seed, bucket size and how the input
is cut into files; the input must keep its rows' order when read twice, as stored files do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from floe.llm.common import shared_path, stored

#: what a task holds of one bucket: its rows are collected, put in order and shuffled
BUCKET_BYTES = 24 << 20


def record_bytes(text: Column) -> Column:
    """Size of a row: UTF-8 bytes of its text (null: none) and 16 for its numbers."""
    return F.coalesce(F.octet_length(text.cast("string")), F.lit(0)).cast("bigint") + 16


def scattered(docs: DataFrame, buckets: int, seed: int) -> DataFrame:
    """Rows (bucket, mark, record): partition i holds bucket i."""
    mark = F.monotonically_increasing_id()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record"), mark.alias("place"))
    rows = rows.select("record", F.xxhash64(F.lit(seed), "place").alias("mark"))
    return rows.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed + 1), "mark"), F.lit(buckets)).cast("int")).repartitionById(buckets, "bucket")


def shuffled(docs: DataFrame, seed: int = 13, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Rows (bucket, place, record), written: the place of every row in its shuffled bucket."""
    total = docs.agg(F.coalesce(F.sum(record_bytes(F.col("text"))), F.lit(0))).first()[0]
    buckets = max(1, -(-total // bucket_bytes))
    ordered = F.array_sort(F.collect_list(F.struct("mark", "record")), lambda a, b: F.when(a["mark"] < b["mark"], -1).when(a["mark"] > b["mark"], 1).otherwise(0))
    each = scattered(docs, buckets, seed).groupBy("bucket").agg(F.shuffle(ordered, F.lit(seed)).alias("rows"))
    path = shared_path(docs.sparkSession, "shuffled")
    each.select("bucket", F.posexplode("rows").alias("place", "row")).select("bucket", "place", "row.record").write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.parquet(path)


def dealt(rows: DataFrame, shards: int) -> DataFrame:
    """shard and slot of rows (bucket, place): equal stretches of the order bucket by bucket."""
    counts = rows.groupBy("bucket").agg(F.count("*").alias("n"))
    ahead, whole = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    starts = counts.select("bucket", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"), F.sum("n").over(whole).alias("total"))
    starts = stored(starts, "starts")  # a written table's size is known: while small it is broadcast and the rows stay where they are
    share, extra = F.expr(f"total div {shards}"), F.col("total") % shards
    longer = extra * (share + 1)  # rows of the shards that hold one more
    rank = F.col("ahead") + F.col("place")
    early = rank < longer
    behind = rank - longer
    ranked = rows.join(starts, "bucket").select("record", early.alias("early"), extra.alias("extra"), F.when(early, rank).otherwise(behind).alias("at"), F.greatest(share + F.when(early, 1).otherwise(0), F.lit(1)).alias("width"))
    shard = F.expr("at div width") + F.when(F.col("early"), 0).otherwise(F.col("extra"))
    return ranked.select("record", shard.cast("int").alias("shard"), (F.col("at") % F.col("width")).alias("slot"))


def sharded(docs: DataFrame, shards: int = 40, seed: int = 13, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """record (all columns of the row), shard and slot (gapless from 0 in its shard)."""
    return dealt(shuffled(docs, seed, bucket_bytes), shards)


def write_shards(placed: DataFrame, path: str) -> None:
    """One folder a shard, rows in the order of their slots."""
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").option("compression", "zstd").parquet(path)
