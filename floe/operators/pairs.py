"""Acquisition pairs: the interval self-join with a spatial-overlap threshold."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from floe.functions import footprints, rings
from floe.functions.geo import polar_xy
from floe.functions.identity import pair_id
from floe.schema import PairRules

PAIR_KEYS = ("path_number", "flight_direction", "beam_mode", "polarization")
_DAY_US = 86400 * 10**6
# the part of a scene inside the area of interest
_PART = ("inside", "convex", "x0", "y0", "x1", "y1")


def aoi_frame(spark: SparkSession, aoi: tuple[float, float, float, float], project: bool = True) -> tuple[tuple[float, float], ...]:
    """The four corners of the area of interest in the comparison plane (four rows, fetched once)."""
    west, south, east, north = map(float, aoi)
    ring = [(west, south), (east, south), (east, north), (west, north)]
    if not project:
        return tuple(ring)
    x, y = polar_xy("lon", "lat")
    rows = spark.createDataFrame([(k, *p) for k, p in enumerate(ring)], "k int, lon double, lat double").select("k", x.alias("x"), y.alias("y"))
    return tuple((r.x, r.y) for r in sorted(rows.collect()))


def usable_scenes(scenes: DataFrame, rules: PairRules, frame: tuple[tuple[float, float], ...], project: bool = True) -> DataFrame:
    """Per-scene work, done once and never per pair: key checks, projection, validity, part inside the AOI.

    Crossing footprints are dropped (``rejected_scenes`` lists them). A scene that covers
    less of the area of interest than the threshold can pair with nothing.
    """
    flat = _judged(scenes.filter(_present(rules)), frame, project).filter("simple")
    return flat.filter(F.col("share") >= rules.min_overlap).drop("simple", "share")


def _present(rules: PairRules) -> Column:
    """Whether a scene has what pairs are matched by."""
    named = [F.col(c).isNotNull() for c in ("path_number", "flight_direction", "beam_mode", "start_time")]
    return F.coalesce(F.array_contains(F.split("polarization", r"\+"), rules.polarization), F.lit(False)) & named[0] & named[1] & named[2] & named[3]


def _measured(df: DataFrame, **columns: Column) -> DataFrame:
    """Add what Arrow functions give; behind a generator, for a later filter pushed below would run them twice."""
    made = df.withColumns({f"_{name}": column for name, column in columns.items()})
    packed = F.struct(*[F.col(f"_{name}").alias(name) for name in columns])
    return made.select(*df.columns, F.inline(F.array(packed)))


def _judged(scenes: DataFrame, frame: tuple[tuple[float, float], ...], project: bool) -> DataFrame:
    ring = F.col("footprint")
    judged = _measured(scenes, judged=footprints.judge(frame)(rings.project_ring(ring) if project else ring))
    return judged.drop("footprint").select("*", "judged.*").drop("judged")


def rejected_scenes(scenes: DataFrame, aoi: tuple[float, float, float, float], rules: PairRules, project: bool = True) -> DataFrame:
    """``file_id, reason`` of scenes that can pair with nothing, beside the pairs: no scene ends the job."""
    judged = _judged(scenes.withColumn("present", _present(rules)), aoi_frame(scenes.sparkSession, aoi, project), project)
    reason = (
        F.when(~F.col("present"), "incomplete or other polarisation").when(~F.coalesce("simple", F.lit(False)), "invalid footprint")
        .when(F.col("share") < rules.min_overlap, "too little of the area")
    )
    return judged.select("file_id", reason.alias("reason")).filter("reason is not null")


def _known(*columns: str) -> Column:
    return reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in columns])


def _shared_box() -> Column:
    """Area common to the boxes of a pair's parts: no less than what the parts share."""
    along = lambda axis: F.greatest(F.least(f"{axis}1_1", f"{axis}1_2") - F.greatest(f"{axis}0_1", f"{axis}0_2"), F.lit(0.0))
    return along("x") * along("y")


def candidate_pairs(scenes: DataFrame, rules: PairRules) -> DataFrame:
    """Ordered pairs with equal keys and an allowed gap.

    The join key includes a time bucket as wide as the largest gap: a later scene
    can only sit in the same or the next bucket. A hot orbit key is thereby split
    over time, and each task compares neighbours instead of the whole key.
    An earlier scene goes only to buckets in which a partner can be.
    """
    width = int(math.ceil(rules.max_days * _DAY_US))
    least, most = int(rules.min_days * _DAY_US), int(rules.max_days * _DAY_US)
    bucket_of = lambda t: F.floor(t / width)
    t = F.col("t")
    placed = scenes.withColumn("t", F.unix_micros(F.col("start_time").cast("timestamp"))).filter(bucket_of(t).isNotNull() & _known(*PAIR_KEYS))
    # both sides read the same columns of one exchange, so that every scene is judged once
    base = placed.select(*PAIR_KEYS, "file_id", "t", *_PART).repartition("file_id")

    def side(k: int, bucket: Column) -> DataFrame:
        own = [F.col("file_id").alias(("first_id", "second_id")[k - 1]), *[F.col(c).alias(f"{c}_{k}") for c in _PART], F.col("t").alias(f"t{k}")]
        return base.select(*PAIR_KEYS, bucket.alias("bucket"), *own)

    first, second = side(1, F.explode(F.sequence(bucket_of(t + least), bucket_of(t + most)))), side(2, bucket_of(t))
    gap = F.col("t2") - F.col("t1")
    joined = first.join(second, [*PAIR_KEYS, "bucket"]).filter(gap.between(least, most))
    return joined.withColumn("baseline_days", gap / float(_DAY_US))


def compatible_pairs(scenes: DataFrame, aoi: tuple[float, float, float, float], rules: PairRules, project: bool = True) -> DataFrame:
    """All acquisition pairs fit for change texture over an area of interest (unordered rows)."""
    frame = aoi_frame(scenes.sparkSession, aoi, project)
    corners = list(zip(frame, frame[1:] + frame[:1]))
    frame_area = abs(sum((x1 - frame[0][0]) * (y2 - frame[0][1]) - (y1 - frame[0][1]) * (x2 - frame[0][0]) for (x1, y1), (x2, y2) in corners)) / 2
    pairs = candidate_pairs(usable_scenes(scenes, rules, frame, project), rules)
    # the margin is far above the rounding of either area
    near = pairs.filter(_shared_box() >= rules.min_overlap * frame_area * (1 - 1e-6))
    fraction = footprints.common_area()("inside_1", "convex_1", "inside_2", "convex_2") / frame_area
    scored = _measured(near, common_aoi_fraction=fraction).filter(F.col("common_aoi_fraction") >= rules.min_overlap)
    start, stop = F.timestamp_micros("t1"), F.timestamp_micros("t2")
    return scored.select(
        pair_id(start, stop, F.col("first_id"), F.col("second_id")).alias("pair_id"),
        "first_id",
        "second_id",
        start.alias("first_time"),
        stop.alias("second_time"),
        *PAIR_KEYS,
        "baseline_days",
        "common_aoi_fraction",
    )


def order_pairs(pairs: DataFrame) -> DataFrame:
    """Total order: second start, baseline, then id."""
    return pairs.orderBy("second_time", "baseline_days", "pair_id")


def select_pairs(pairs: DataFrame, offset: int, count: int) -> DataFrame:
    """A slice of the ordered list (the caller's pair index and maximum)."""
    return order_pairs(pairs).offset(offset).limit(count)


def capped(df: DataFrame, order: list[str], cap: int) -> DataFrame:
    """At most ``cap`` rows, flagged ``possibly_truncated`` when the cap was reached."""
    taken = df.orderBy(*order).limit(cap)
    everything = Window.partitionBy(F.lit(1))  # at most ``cap`` rows, already in one partition
    return taken.withColumn("possibly_truncated", F.count("*").over(everything) >= cap)
