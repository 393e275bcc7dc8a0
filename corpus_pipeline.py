"""From raw documents to packed training sequences, one operator per stage, each stage written and read again."""

from __future__ import annotations

from floe.llm import decontaminate, jaccard, language, packing, suffix
from floe.llm.common import shared_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; texts without a letter, null ones among them, go."""
    return language.accepted(docs, language.fit(docs))


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest id, of each group linked by a Jaccard likeness of at least 0.8 of five-word shingles."""
    return jaccard.one_of_each(docs, n=5, percent=80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the characters that repeated strings of 200 bytes cover."""
    return suffix.without_repeats(docs)


def remove_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item within a fifth of its words."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of a document with its token ids (little-endian 32-bit), their digest, its sequence and offset."""
    packed = packing.pack(docs, packing.default_tokenizer())
    return packed.select("doc_id", "start", "length", "ids", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", join_near_duplicates),
    ("repeated_strings", cut_repeats),
    ("benchmark_leaks", remove_leaks),
    ("packing", pack_sequences),
]

#: the first stage is a trained model, so no SQL gives the rows; tests hold each stage against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
