"""Session settings and durable intermediate results."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Pin what results and speed depend on: UTC clock, adaptive execution with skew handling, and
    generated methods small enough for the JVM to compile (it leaves larger ones interpreted).
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a temporary one only where none is configured and all tasks run on this machine."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and (not context.master.startswith("local") or context.master.startswith("local-cluster")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    return context.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """Cut lineage on the shared folder so that a lost executor never recomputes earlier rounds."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
