"""Annotated scene folders: names, file choice."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Folder name and file name patterns of annotated scenes.
SCENE_NAME = r"^([a-zA-Z0-9-]+)_(\d{8})_(\d{8})$"


def parse_scene_names(scenes: DataFrame, name: str = "scene") -> DataFrame:
    """Region and both days from ``region_yyyymmdd_yyyymmdd``; bad names carry a reason."""
    part = lambda k: F.regexp_extract(name, SCENE_NAME, k)
    day = lambda k: F.try_to_date(F.nullif(part(k), F.lit("")), "yyyyMMdd") if hasattr(F, "try_to_date") else F.to_date(
        F.try_to_timestamp(F.nullif(part(k), F.lit("")), F.lit("yyyyMMdd"))
    )
    parsed = scenes.withColumns(
        {
            "region": F.lower(F.nullif(part(1), F.lit(""))),
            "first_date": day(2),
            "second_date": day(3),
        }
    )
    problem = F.when(F.col("first_date").isNull() | F.col("second_date").isNull(), "invalid name").when(
        F.col("first_date") >= F.col("second_date"), "dates not ordered"
    )
    return parsed.withColumn("problem", problem)


def select_rgb(files: DataFrame, polarization: str) -> DataFrame:
    """RGB file of each scene from ``scene, dates, file_name, hash``.

    ``<pol>_rgb_image_<dates>.npy`` comes first; the unprefixed name counts only for HH.
    Both present with different contents is an error row, never a silent choice.
    """
    if polarization not in ("HH", "HV"):
        raise ValueError("polarization must be HH or HV")
    explicit = F.concat(F.lit(f"{polarization}_rgb_image_"), F.col("dates"), F.lit(".npy"))
    generic = F.concat(F.lit("rgb_image_"), F.col("dates"), F.lit(".npy"))
    present = files.groupBy("scene").agg(
        F.max(F.when(F.col("file_name") == explicit, F.struct("file_name", "hash"))).alias("explicit"),
        F.max(F.when(F.col("file_name") == generic, F.struct("file_name", "hash"))).alias("generic"),
    )
    fallback = F.col("generic") if polarization == "HH" else F.lit(None)
    chosen = F.coalesce(F.col("explicit"), fallback)
    both = F.col("explicit").isNotNull() & F.col("generic").isNotNull()
    status = (
        F.when(both & (F.col("explicit.hash") != F.col("generic.hash")), "ambiguous")
        .when(chosen.isNull(), "missing")
        .otherwise("ok")
    )
    return present.select("scene", chosen["file_name"].alias("file_name"), chosen["hash"].alias("hash"), status.alias("status"))
