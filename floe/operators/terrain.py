"""Elevation: land/ocean merge and coverage checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from floe.session import durable

BINS, SMALL = 4096, 100_000


def combine_elevation(cells: DataFrame) -> DataFrame:
    """Land takes terrain, all ocean takes the geoid even where terrain exists.

    ``cells``: ``land, terrain, geoid``. A gap on either side stays NULL with a reason.
    """
    return cells.withColumns(
        {
            "elevation": F.when(F.col("land"), F.col("terrain")).otherwise(F.col("geoid")),
            "problem": F.when(F.col("land") & F.col("terrain").isNull(), "missing terrain on land").when(
                ~F.col("land") & F.col("geoid").isNull(), "missing geoid on ocean"
            ),
        }
    )


def merge_report(merged: DataFrame, keys: list[str], extra: list[Column] | None = None) -> DataFrame:
    """Cell counts per surface and per failure of a merge, with further aggregates from the same pass."""
    number = lambda condition: F.count(F.when(condition, 1))
    return merged.groupBy(*keys).agg(
        number(F.col("land")).alias("land_cells"),
        number(~F.col("land")).alias("ocean_cells"),
        number(F.col("problem") == "missing terrain on land").alias("missing_land"),
        number(F.col("problem") == "missing geoid on ocean").alias("missing_ocean"),
        *(extra or []),
    )


def strict_elevation(merged: DataFrame) -> DataFrame:
    """The merged elevation, failing the job at the first gap."""
    return merged.withColumn(
        "elevation", F.when(F.col("problem").isNotNull(), F.raise_error(F.col("problem"))).otherwise(F.col("elevation"))
    ).drop("problem")


def coverage_report(cells: DataFrame, value: str = "terrain") -> DataFrame:
    """Samples and gaps on land and on ocean; percentage NULL where a surface has no sample."""
    surfaces = (("land", F.col("land")), ("ocean", ~F.col("land")))
    totals = cells.agg(
        *[F.count(F.when(on, 1)).alias(f"{name}_n") for name, on in surfaces],
        *[F.count(F.when(on & F.col(value).isNull(), 1)).alias(f"{name}_missing") for name, on in surfaces],
    )
    row = lambda name: F.struct(
        F.lit(name).alias("surface"), F.col(f"{name}_n").alias("samples"), F.col(f"{name}_missing").alias("missing")
    )
    listed = totals.select(F.inline(F.array(row("land"), row("ocean"))))
    return listed.withColumn("missing_percent", F.try_divide(F.col("missing") * 100.0, F.col("samples")))


def exact_percentiles(df: DataFrame, value: Column, probabilities: list[float], keys: list[str], bins: int = BINS, small: int = SMALL) -> DataFrame:
    """Exact percentiles with linear interpolation: ``keys, p, value``.

    The built-in exact percentile keeps every distinct value of a group in one task. Here values are counted first, and a
    histogram of fixed size finds the bins that hold the wanted ranks. A bin that still holds more than ``small`` distinct
    values, as after an outlier, is cut again within its own reach, in turns on a plain and on a logarithmic scale, so that
    no distribution stays in one bin; at most ``small`` values are ranked in a task. Missing values count for nothing; a group
    without values has no row.
    """
    counted = df.filter(value.isNotNull()).groupBy(*keys, value.cast("double").alias("v")).agg(F.count("*").alias("n"))
    wanted = F.explode(F.array(*[F.lit(float(p)) for p in probabilities]))
    goals = counted.groupBy(*keys).agg(F.sum("n").alias("total")).filter("total > 0").withColumn("p", wanted)
    goals = goals.withColumn("rank", F.col("p") * (F.col("total") - 1)).drop("total")
    goals = goals.withColumn("end", F.explode(F.array_distinct(F.array(F.floor("rank"), F.ceil("rank")))))
    goals = goals.withColumns({"bin": F.lit(""), "before": F.lit(0).cast("bigint")})
    live = counted.withColumn("bin", F.lit(""))
    step, logarithmic, sizes = [*keys, "bin"], False, []
    while True:
        live, goals, most = _cut_bins(live, goals, step, bins, logarithmic)
        sizes.append(most)
        if most <= small or sizes[-3:] == [most] * 3:  # infinite values cannot be told apart by any scale: they are ranked as they are
            break
        live, goals, logarithmic = durable(live), durable(goals), not logarithmic
    within = Window.partitionBy(*step).orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = live.withColumn("first", F.coalesce(F.sum("n").over(within), F.lit(0)))
    place = F.col("end") - F.col("before")
    found = goals.join(ranked, step).filter((place >= F.col("first")) & (place < F.col("first") + F.col("n")))
    low = F.max(F.when(F.col("end") == F.floor("rank"), F.col("v")))
    high = F.max(F.when(F.col("end") == F.ceil("rank"), F.col("v")))
    fraction = F.col("rank") - F.floor("rank")
    return found.groupBy(*keys, "p", "rank").agg(low.alias("low"), high.alias("high")).select(
        *keys, "p", (F.col("low") + fraction * (F.col("high") - F.col("low"))).alias("value")
    )


def _cut_bins(live: DataFrame, goals: DataFrame, step: list[str], bins: int, logarithmic: bool) -> tuple[DataFrame, DataFrame, int]:
    """Values and ranks in the finer bins that hold a wanted rank, and the most distinct values in one of these."""
    scaled = F.signum("v") * F.log1p(F.abs(F.col("v")) * 1e9) if logarithmic else F.col("v")  # both rise with the value
    live = live.withColumn("scaled", scaled)
    reach = live.groupBy(*step).agg(F.min("scaled").alias("lo"), F.max("scaled").alias("hi"))
    span = F.col("hi") - F.col("lo")
    part = F.when(span > 0, F.least(F.floor((F.col("scaled") - F.col("lo")) / span * bins), F.lit(bins - 1))).otherwise(F.lit(0))
    cut = live.join(reach, step).withColumn("part", part.cast("bigint")).drop("lo", "hi", "scaled")
    running = Window.partitionBy(*step).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    histogram = cut.groupBy(*step, "part").agg(F.sum("n").alias("in_part"), F.count("*").alias("distinct"))
    histogram = histogram.withColumn("passed", F.coalesce(F.sum("in_part").over(running), F.lit(0)))
    place = F.col("end") - F.col("before")
    hits = goals.join(histogram, step).filter((place >= F.col("passed")) & (place < F.col("passed") + F.col("in_part")))
    name = F.concat("bin", F.lit("."), F.col("part").cast("string"))
    found = hits.withColumns({"before": F.col("before") + F.col("passed"), "bin": name}).drop("part", "in_part", "passed", "distinct")
    kept = cut.withColumn("bin", name).drop("part").join(found.select(*step).distinct(), step, "left_semi")
    most = hits.agg(F.coalesce(F.max("distinct"), F.lit(0))).first()[0]
    return kept, found, most
