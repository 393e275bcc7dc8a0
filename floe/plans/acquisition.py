"""From a scene catalogue to pairs, and the orbit files they need."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floe.operators.orbits import match_orbits, match_sound_orbits
from floe.operators.pairs import compatible_pairs
from floe.schema import PairRules
from floe.sources.catalog import search_catalog
from floe.sources.orbits import parse_orbit_names


def discover_pairs(
    scenes: DataFrame,
    aoi: tuple[float, float, float, float],
    start_date: str,
    end_date: str,
    beam_modes: list[str],
    levels: list[str],
    rules: PairRules | None = None,
    max_results: int | None = None,
) -> DataFrame:
    """Search the catalogue and pair what it returns; order with ``order_pairs`` when listing."""
    found = search_catalog(scenes, aoi, start_date, end_date, beam_modes, levels, max_results=max_results)
    return compatible_pairs(found, aoi, rules or PairRules())


def orbit_readiness(scenes: DataFrame, listing: DataFrame, vectors: DataFrame | None = None) -> DataFrame:
    """Scenes by mission and by whether a published orbit file covers them.

    With the vectors of the files (``read_orbit_vectors``) a file counts only if its content is sound and covers the scene.
    """
    names = parse_orbit_names(listing)
    matched = match_orbits(scenes, names) if vectors is None else match_sound_orbits(scenes, names, vectors)
    return matched.groupBy("mission", "status").agg(
        F.count("*").alias("scenes"), F.countDistinct("orbit_name").alias("orbit_files"), F.sum("candidates").alias("candidates")
    )
