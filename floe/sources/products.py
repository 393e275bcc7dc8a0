"""Product manifests: recursive reader and the product sink."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from floe.streaming.incremental import plan_work

# Manifest fields.
MANIFEST = """
  product_id bigint, pair_id string, region string, first_time string, second_time string, created_utc string,
  synthetic boolean, status string, baseline_days double, fingerprint string, implementation_hash string,
  classification_available boolean, mask_provided boolean, valid_texture_fraction double,
  resource_hashes map<string,string>, limitations array<string>,
  config struct<processing: string, segmentation: string, classifier: string, coastline: string>,
  metrics struct<candidate_fast_ice_km2: double, observed_ocean_km2: double, unknown_pixels: bigint>"""


def flatten_manifests(documents: DataFrame) -> DataFrame:
    """Manifest documents to product rows with times as instants."""
    times = {
        "first_time": F.to_timestamp("first_time"),
        "second_time": F.to_timestamp("second_time"),
        "created_time": F.to_timestamp("created_utc"),
    }
    available = F.coalesce("classification_available", F.col("status") == "candidate_classification")
    return documents.withColumns({**times, "classification_available": available}).drop("created_utc")


def read_products(spark: SparkSession, root: str) -> DataFrame:
    """Every ``manifest.json`` below a root."""
    reader = spark.read.schema(MANIFEST).option("multiLine", True)
    documents = reader.option("recursiveFileLookup", True).option("pathGlobFilter", "manifest.json").json(root)
    return flatten_manifests(documents)


def parse_manifests(lines: DataFrame, column: str = "json") -> DataFrame:
    """Manifests as JSON text, one per row."""
    return flatten_manifests(lines.select(F.inline(F.array(F.from_json(column, MANIFEST)))))


def write_product(df: DataFrame, path: str, partitions: tuple[str, ...] = ("region", "pair_id")) -> None:
    """Commit a product table atomically; an existing product is never replaced.

    Rows are clustered by product first, so each product is one file set.
    """
    df.repartition(*partitions).write.mode("errorifexists").partitionBy(*partitions).parquet(path)


# --- a store that grows: products below data/, and a log of what was committed

LOG = "pair_id string, fingerprint string, commit string"


def committed(spark: SparkSession, root: str) -> DataFrame:
    """``pair_id, fingerprint, commit`` of every published product; of commits that raced for a pair the first counts."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/log")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], LOG)
    first = F.min(F.struct("commit", "fingerprint")).alias("first")
    return spark.read.schema(LOG).parquet(f"{root}/log").groupBy("pair_id").agg(first).select("pair_id", "first.fingerprint", "first.commit")


def decide(candidates: DataFrame, known: DataFrame) -> DataFrame:
    """``pair_id, fingerprint, existing, action`` of every candidate, against a store and within the batch.

    A pair that a batch offers under several fingerprints (a missing one counts) is a conflict.
    """
    offered = candidates.select("pair_id", "fingerprint").distinct()
    many = F.count("*").over(Window.partitionBy("pair_id")) > 1
    planned = plan_work(offered.withColumn("several", many), known)
    action = F.when((F.col("action") == "process") & F.col("several"), "conflict").otherwise(F.col("action"))
    return planned.select("pair_id", "fingerprint", "existing", action.alias("action"))


def publish(rows: DataFrame, root: str) -> DataFrame:
    """Publish the products that a store lacks and say what became of each: ``process``, ``reuse`` or ``conflict``.

    ``rows`` hold ``pair_id, fingerprint`` and anything else, many rows a product. They are
    written below a new commit first; only the log entry makes them visible, so a lost task
    or job leaves nothing that a reader sees. Products are never replaced.
    """
    spark = rows.sparkSession
    commit = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
    actions = f"{root}/actions/{commit}"
    decide(rows, committed(spark, root)).write.parquet(actions)  # decided once, read by all that follows
    decided = spark.read.parquet(actions)
    fresh = decided.filter("action = 'process'").select(F.col("pair_id").alias("p"), F.col("fingerprint").alias("f"))
    new = rows.join(fresh, (rows["pair_id"] == fresh["p"]) & rows["fingerprint"].eqNullSafe(fresh["f"]), "left_semi")
    new.write.parquet(f"{root}/data/commit={commit}")
    entries = fresh.select(F.col("p").alias("pair_id"), F.col("f").alias("fingerprint"), F.lit(commit).alias("commit"))
    entries.coalesce(1).write.mode("append").parquet(f"{root}/log")
    return decided


def read_published(spark: SparkSession, root: str) -> DataFrame:
    """The rows of all committed products."""
    rows = spark.read.option("basePath", f"{root}/data").option("mergeSchema", True).parquet(f"{root}/data")
    kept = committed(spark, root).select("pair_id", "commit")
    return rows.join(kept, ["pair_id", "commit"], "left_semi").drop("commit")
