"""Orbit files: names and state vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Orbit file naming scheme and time format.
NAME = r"^(S1[ABCD])_OPER_AUX_POEORB_OPOD_(\d{8}T\d{6})_V(\d{8}T\d{6})_(\d{8}T\d{6})\.EOF(\.zip)?$"
STAMP = "yyyyMMdd'T'HHmmss"

# Element layout of an orbit document.
DOCUMENT = """struct<
  Earth_Explorer_Header: struct<Fixed_Header: struct<File_Type: string, Mission: string,
    Validity_Period: struct<Validity_Start: string, Validity_Stop: string>>>,
  Data_Block: struct<List_of_OSVs: struct<OSV: array<struct<UTC: string, X: double, Y: double, Z: double,
    VX: double, VY: double, VZ: double>>>>>"""


def parse_orbit_names(names: DataFrame, column: str = "name") -> DataFrame:
    """Mission, creation and validity from file names; other names are dropped."""
    part = lambda k: F.regexp_extract(column, NAME, k)
    # lenient, because a filter may be evaluated after the columns it guards
    stamp = lambda k: F.try_to_timestamp(part(k), F.lit(STAMP))
    return names.filter(F.col(column).rlike(NAME)).select(
        "*", part(1).alias("mission"), stamp(2).alias("creation"), stamp(3).alias("valid_from"), stamp(4).alias("valid_to")
    )


def parse_orbit_documents(documents: DataFrame, file: str = "file", xml: str = "xml") -> DataFrame:
    """Orbit XML text to rows ``file, file_type, mission_name, header_from, header_to, pos, t, x..vz``."""
    # behind a generator, so that each document is parsed once and not once per column
    parsed = documents.select(file, F.explode(F.array(F.from_xml(xml, DOCUMENT))).alias("d"))
    utc = lambda c: F.to_timestamp(F.regexp_replace(c, "^UTC=", ""))
    head = "d.Earth_Explorer_Header.Fixed_Header"
    vectors = parsed.select(
        file,
        F.col(f"{head}.File_Type").alias("file_type"),
        F.col(f"{head}.Mission").alias("mission_name"),
        utc(F.col(f"{head}.Validity_Period.Validity_Start")).alias("header_from"),
        utc(F.col(f"{head}.Validity_Period.Validity_Stop")).alias("header_to"),
        F.posexplode_outer("d.Data_Block.List_of_OSVs.OSV").alias("pos", "v"),
    )
    components = [F.col(f"v.{c}").alias(c.lower()) for c in ("X", "Y", "Z", "VX", "VY", "VZ")]
    return vectors.select(file, "file_type", "mission_name", "header_from", "header_to", "pos", utc(F.col("v.UTC")).alias("t"), *components)


def read_orbit_vectors(spark: SparkSession, path: str) -> DataFrame:
    """Orbit files under a path (plain EOF XML, at most a few MB each)."""
    texts = spark.read.option("wholetext", True).text(path)
    name = F.substring_index(F.input_file_name(), "/", -1)
    return parse_orbit_documents(texts.select(name.alias("file"), F.col("value").alias("xml")))


def header_problems(vectors: DataFrame, names: DataFrame) -> DataFrame:
    """Files whose header contradicts their name (type, spacecraft or validity)."""
    heads = vectors.select("file", "file_type", "mission_name", "header_from", "header_to").distinct()
    joined = heads.join(names.withColumnRenamed("name", "file"), "file")
    expected = F.concat(F.lit("Sentinel-1"), F.substring("mission", 3, 1))
    reasons = F.array_compact(
        F.array(
            F.when(~F.col("file_type").eqNullSafe(F.lit("AUX_POEORB")), "file type"),
            F.when(~F.col("mission_name").eqNullSafe(expected), "spacecraft"),
            F.when(
                ~(F.col("header_from").eqNullSafe(F.col("valid_from")) & F.col("header_to").eqNullSafe(F.col("valid_to"))), "validity"
            ),
        )
    )
    return joined.select("file", reasons.alias("reasons")).filter(F.size("reasons") > 0)
