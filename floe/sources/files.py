"""Content hashes of files and of binary columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def hash_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """SHA-256 of every file's bytes; a vector file's sidecars are ordinary rows of the listing."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(
        F.substring_index("path", "/", -1).alias("file_name"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256")
    )


def hash_contents(df: DataFrame, content: str, out: str = "sha256") -> DataFrame:
    """SHA-256 of a text or binary column."""
    return df.withColumn(out, F.sha2(F.col(content).cast("binary"), 256))
