"""Orbit files: which one covers a scene, and whether its vectors are sound."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from floe.sources.orbits import header_problems

MARGIN_SECONDS = 60
MISSIONS = ("S1A", "S1B", "S1C", "S1D")


def scene_windows(scenes: DataFrame, margin: int = MARGIN_SECONDS) -> DataFrame:
    """The interval an orbit file must cover; rows that cannot have one carry a reason."""
    start, stop = F.col("start_time").cast("timestamp"), F.col("stop_time").cast("timestamp")
    pad = F.make_dt_interval(secs=F.lit(float(margin)))
    reason = (
        F.when(~F.coalesce(F.col("mission").isin(*MISSIONS), F.lit(False)), "unknown_mission")
        .when(start.isNull() | stop.isNull() | (stop <= start), "invalid_interval")
    )
    return scenes.select(
        "file_id", "mission", (start - pad).alias("need_from"), (stop + pad).alias("need_to"), reason.alias("problem")
    )


def _covering(windows: DataFrame, orbits: DataFrame) -> DataFrame:
    """Scene windows ``w`` with the files ``o`` whose names cover them; windows without one stay.

    Orbit files span about a day, so each is listed under the days it touches and
    the join is on (mission, day); the interval test runs on those few rows.
    """
    times = {c: F.col(c).cast("timestamp") for c in ("creation", "valid_from", "valid_to")}
    by_day = orbits.withColumns(times).withColumn("day", F.explode(F.sequence(F.to_date("valid_from"), F.to_date("valid_to"))))
    w, o = windows.withColumn("day", F.to_date("need_from")).alias("w"), by_day.alias("o")
    return w.join(
        o,
        (F.col("w.mission") == F.col("o.mission"))
        & (F.col("w.day") == F.col("o.day"))
        & F.col("w.problem").isNull()
        & (F.col("o.valid_from") <= F.col("w.need_from"))
        & (F.col("w.need_to") <= F.col("o.valid_to")),
        "left",
    )


def match_orbits(scenes: DataFrame, orbits: DataFrame, margin: int = MARGIN_SECONDS) -> DataFrame:
    """Newest orbit file covering each scene; scenes without one stay, with status ``no_orbit``.

    The winner is a partial aggregate, not a sort.
    """
    covered = _covering(scene_windows(scenes, margin), orbits.select("mission", "name", "creation", "valid_from", "valid_to"))
    best = covered.groupBy("w.file_id", "w.mission", "w.problem").agg(
        F.max(F.when(F.col("o.name").isNotNull(), F.struct("o.creation", "o.name"))).alias("best"),
        F.count("o.name").alias("candidates"),
    )
    status = F.coalesce(F.col("problem"), F.when(F.col("best").isNull(), "no_orbit"), F.lit("matched"))
    return best.select("file_id", "mission", F.col("best.name").alias("orbit_name"), "candidates", status.alias("status"))


def unordered_vectors(vectors: DataFrame) -> DataFrame:
    """Vectors not later than the one listed before them in the same file."""
    order = Window.partitionBy("file").orderBy("pos")
    return vectors.withColumn("before", F.lag("t").over(order)).filter(F.col("before") >= F.col("t"))


def vector_facts(vectors: DataFrame) -> DataFrame:
    """Per file: number of vectors, whether times rise and components are finite, first and last time."""
    order = Window.partitionBy("file").orderBy("pos")
    finite = F.lit(True)
    for name in ("x", "y", "z", "vx", "vy", "vz"):
        value = F.col(name)
        finite = finite & value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))
    before = F.lag("t").over(order)
    return (
        vectors.withColumn("rising", F.when(F.row_number().over(order) == 1, F.col("t").isNotNull()).otherwise(F.coalesce(before < F.col("t"), F.lit(False))))
        .withColumn("finite", finite)
        .groupBy("file")
        .agg(
            F.count("*").alias("vectors"),
            F.bool_and("rising").alias("rising"),
            F.bool_and("finite").alias("finite"),
            F.min_by("t", "pos").alias("first_t"),
            F.max_by("t", "pos").alias("last_t"),
        )
    )


def orbit_vector_checks(vectors: DataFrame, files: DataFrame) -> DataFrame:
    """Per file: at least two vectors, rising times, finite components, interval covered.

    ``files`` carries ``file, valid_from, valid_to`` and keeps files without vectors.
    """
    covers = (F.col("first_t") <= F.col("valid_from")) & (F.col("valid_to") <= F.col("last_t"))
    false = F.lit(False)
    checked = files.join(vector_facts(vectors), "file", "left").select(
        "file",
        F.coalesce("vectors", F.lit(0)).alias("vectors"),
        F.coalesce("rising", false).alias("rising"),
        F.coalesce("finite", false).alias("finite"),
        F.coalesce(covers, false).alias("covers"),
    )
    return checked.withColumn("sound", (F.col("vectors") >= 2) & F.col("rising") & F.col("finite") & F.col("covers"))


def sound_files(orbits: DataFrame, vectors: DataFrame) -> DataFrame:
    """Listed files that were read and hold what their name says: ``name, vectors_from, vectors_to``.

    The header agrees with the name, times rise over at least two vectors, and no component is missing or infinite.
    A file without vectors, or never read, is not sound. ``vectors`` are the rows of ``parse_orbit_documents``.
    """
    usable = vectors.filter(F.col("pos").isNotNull()).withColumn("file", F.regexp_replace("file", r"\.zip$", ""))
    named = orbits.select(F.regexp_replace("name", r"\.zip$", "").alias("name"), "mission", "valid_from", "valid_to").distinct()
    denied = header_problems(vectors.withColumn("file", F.regexp_replace("file", r"\.zip$", "")), named).select("file")
    facts = vector_facts(usable).filter((F.col("vectors") >= 2) & F.col("rising") & F.col("finite"))
    facts = facts.join(denied, "file", "left_anti").withColumnsRenamed({"first_t": "vectors_from", "last_t": "vectors_to"})
    own = orbits.select("name").distinct().withColumn("file", F.regexp_replace("name", r"\.zip$", ""))
    return own.join(facts, "file").select("name", "vectors_from", "vectors_to")


def match_sound_orbits(scenes: DataFrame, orbits: DataFrame, vectors: DataFrame, margin: int = MARGIN_SECONDS) -> DataFrame:
    """Newest sound orbit file whose name and vectors both cover the scene with its margin.

    Status is ``matched``, ``unsound_orbit`` (files cover it by name, none by content), ``no_orbit``, or why the
    scene can have none. Content is checked once a file, not once a scene; a scene meets the few files of its day.
    """
    checked = orbits.join(sound_files(orbits, vectors), "name", "left")
    covered = _covering(scene_windows(scenes, margin), checked)
    holds = F.coalesce((F.col("o.vectors_from") <= F.col("w.need_from")) & (F.col("w.need_to") <= F.col("o.vectors_to")), F.lit(False))
    best = covered.groupBy("w.file_id", "w.mission", "w.problem").agg(
        F.max(F.when(holds, F.struct("o.creation", "o.name"))).alias("best"),
        F.count("o.name").alias("candidates"),
        F.count_if(holds).alias("sound"),
    )
    found = F.when(F.col("candidates") == 0, "no_orbit").when(F.col("sound") == 0, "unsound_orbit").otherwise("matched")
    return best.select("file_id", "mission", F.col("best.name").alias("orbit_name"), "candidates", "sound", F.coalesce("problem", found).alias("status"))
