"""Published products over time: latest, previous comparable, reuse, review, wording."""

from __future__ import annotations

from calendar import monthrange
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from floe.schema import FEATURES, STATUS_CLASSIFIED, STATUS_SEGMENTED

# Products are ranked by second acquisition, first acquisition, creation, id.
ORDER = ("second_time", "first_time", "created_time", "product_id")
MAX_AGE_DAYS = 14
CONFIG_SECTIONS = ("processing", "segmentation", "classifier", "coastline")


def ordered_products(products: DataFrame) -> DataFrame:
    return products.orderBy(*ORDER)


def _end_of_day(day: Column) -> Column:
    """23:59:59 of a date: as-of cut-offs include the whole day to the second."""
    return F.to_timestamp(F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" 23:59:59")))


def _row(columns: list[str]) -> Column:
    return F.struct(*columns)


def latest_product(products: DataFrame, as_of: str) -> DataFrame:
    """Last product of each region by a date, as one partial aggregate."""
    visible = products.filter(F.col("second_time") <= _end_of_day(F.lit(as_of).cast("date")))
    rest = [c for c in products.columns if c != "region"]
    best = visible.groupBy("region").agg(F.max_by(_row(rest), _row(list(ORDER))).alias("best"))
    return best.select("region", "best.*")


def season_dates(spark, start_year: int, start_month: int = 9, end_month: int = 4) -> DataFrame:
    """Weekly issue dates from the first of the start month to the last day of the end month next year."""
    first = F.make_date(F.lit(start_year), F.lit(start_month), F.lit(1))
    last = F.last_day(F.make_date(F.lit(start_year + 1), F.lit(end_month), F.lit(1)))
    weeks = F.sequence(first, last, F.expr("interval 7 days"))
    return spark.range(1).select(F.posexplode(weeks).alias("week", "issue_date"))


def latest_per_week(products: DataFrame, start_year: int, start_month: int = 9, end_month: int = 4, columns: list[str] | None = None) -> DataFrame:
    """Latest product of every region at every weekly issue date; dates before any product are absent.

    Each product is filed under the first issue that can see it and aggregated there;
    a running maximum over the season's few dozen weeks then carries the winner
    forward. No product is compared with more than one date.
    """
    dates = season_dates(products.sparkSession, start_year, start_month, end_month)
    opening = date(start_year, start_month, 1)
    closing = date(start_year + 1, end_month, monthrange(start_year + 1, end_month)[1])
    last_week = (closing - opening).days // 7
    offset = F.datediff(F.to_date("second_time"), F.lit(opening.isoformat()).cast("date"))
    # A product is visible from its own day on; one in the day's last fraction of a second, a day later.
    late = F.col("second_time") > _end_of_day(F.to_date("second_time"))
    week = F.when(late, F.floor(offset / 7) + 1).otherwise(F.ceil(offset / 7))
    filed = products.withColumn("week", F.greatest(week, F.lit(0)).cast("int")).filter(F.col("week") <= last_week)
    rest = columns or [c for c in products.columns if c != "region"]
    rank = _row(list(ORDER))
    best = filed.groupBy("region", "week").agg(F.max_by(_row(rest), rank).alias("row"), F.max(rank).alias("rank"))
    weeks = best.select("region").distinct().withColumn("week", F.explode(F.sequence(F.lit(0), F.lit(last_week))))
    carried = Window.partitionBy("region").orderBy("week").rowsBetween(Window.unboundedPreceding, 0)
    filled = weeks.join(best, ["region", "week"], "left").withColumn("row", F.max_by("row", "rank").over(carried))
    return filled.filter(F.col("row").isNotNull()).join(F.broadcast(dates), "week").select("region", "issue_date", "row.*")


def previous_product(products: DataFrame, columns: list[str], bucket: str = "year") -> DataFrame:
    """For each product the last one with a strictly earlier second time, equal ``synthetic`` and ``status``.

    Adds ``prev_<column>``; NULL where there is none. One winner per time stamp is
    aggregated first. Looking back is then split by time: a lag inside each bucket, and
    for its first stamp the last stamp of the nearest earlier bucket, so a region that
    holds most products still spreads over many tasks.
    """
    keys = ["region", "synthetic", "status"]
    winner = F.max_by(_row(columns), _row(["first_time", "created_time", "product_id"])).alias("row")
    stamps = products.groupBy(*keys, "second_time").agg(winner)
    stamps = stamps.withColumn("bucket", F.date_trunc(bucket, F.col("second_time").cast("timestamp")))
    inside = Window.partitionBy(*keys, "bucket").orderBy("second_time")
    stamps = stamps.withColumn("before", F.lag("row").over(inside))
    tails = stamps.groupBy(*keys, "bucket").agg(F.max_by("row", "second_time").alias("tail"))
    over = Window.partitionBy(*keys).orderBy("bucket")  # one row per bucket
    tails = tails.select(*keys, "bucket", F.lag("tail").over(over).alias("carried"))
    resolved = stamps.join(tails, [*keys, "bucket"]).select(*keys, "second_time", F.coalesce("before", "carried").alias("prev"))
    joined = products.join(resolved, [*keys, "second_time"])
    return joined.select(*products.columns, *[F.col(f"prev.{c}").alias(f"prev_{c}") for c in columns])


def comparable(left: dict[str, Column], right: dict[str, Column]) -> Column:
    """Whether two products may be compared: settings, resource hashes, code and grid all equal.

    Both sides map ``processing, segmentation, classifier, coastline, resource_hashes
    (map), implementation_hash, grid``; NULL equals NULL.
    """
    ok = F.lit(True)
    for name in (*CONFIG_SECTIONS, "implementation_hash", "grid"):
        ok = ok & left[name].eqNullSafe(right[name])
    entries = lambda side: F.array_sort(F.map_entries(side["resource_hashes"]))
    return ok & entries(left).eqNullSafe(entries(right))


def new_pairs(candidates: DataFrame, products: DataFrame) -> DataFrame:
    """Candidates ``pair_id, fingerprint`` without a finished product under the same identity."""
    return candidates.join(products.select("pair_id").distinct(), "pair_id", "left_anti")


def reused_pairs(candidates: DataFrame, products: DataFrame) -> DataFrame:
    """Candidates whose product exists with the same fingerprint."""
    return candidates.join(products.select("pair_id", "fingerprint").distinct(), ["pair_id", "fingerprint"], "left_semi")


def conflicting_pairs(candidates: DataFrame, products: DataFrame) -> DataFrame:
    """Candidates with products, none of them under the same fingerprint: never overwritten, always an error.

    One row a stored fingerprint. A missing fingerprint equals nothing, so every candidate is new, reused or in conflict.
    """
    known = products.select("pair_id", F.col("fingerprint").alias("existing")).distinct()
    return candidates.join(reused_pairs(candidates, products), ["pair_id", "fingerprint"], "left_anti").join(known, "pair_id")


def review_transfer(requests: DataFrame, models: DataFrame, products: DataFrame) -> DataFrame:
    """Whether a model may classify a product, for each requested (model_id, product_id).

    Models: ``model_id, region, synthetic, features, polarization, contract,
    requires_review``. Products: ``product_id, region, synthetic, polarization,
    contract, allow_transfer``. Hard failures refuse, an unknown model or product among
    them; softer issues need an explicit permission. Every request gets a row.
    """
    m, p = models.alias("m"), products.alias("p")
    joined = requests.join(m, "model_id", "left").join(p, "product_id", "left")
    unknown_model, unknown_product = F.col("m.features").isNull() & F.col("m.region").isNull(), F.col("p.region").isNull()
    both = ~unknown_model & ~unknown_product
    c = F.col
    hard = F.array_compact(
        F.array(
            F.when(unknown_model, "unknown model"),
            F.when(unknown_product, "unknown product"),
            F.when(c("m.synthetic") & ~c("p.synthetic"), "synthetic model on real scene"),
            F.when(~unknown_model & ~c("m.features").eqNullSafe(F.lit(FEATURES)), "unsupported features"),
            F.when(~unknown_product & c("m.polarization").isNotNull() & ~c("m.polarization").eqNullSafe(c("p.polarization")), "polarization differs"),
        )
    )
    soft = F.array_compact(
        F.array(
            F.when(both & ~c("m.region").eqNullSafe(c("p.region")), "region differs"),
            F.when(both & c("m.contract").isNotNull() & ~c("m.contract").eqNullSafe(c("p.contract")), "contract differs"),
            F.when(both & (F.coalesce(c("m.requires_review"), F.lit(False)) | c("m.contract").isNull()), "provenance incomplete"),
        )
    )
    status = (
        F.when(F.size("hard") > 0, "refused")
        .when(F.size("soft") == 0, "accepted")
        .when(F.coalesce(c("allow_transfer"), F.lit(False)), "accepted_transfer")
        .otherwise("needs_permission")
    )
    reviewed = joined.select("model_id", "product_id", "p.allow_transfer", hard.alias("hard"), soft.alias("soft"))
    return reviewed.select("model_id", "product_id", F.concat("hard", "soft").alias("issues"), status.alias("review"))


def observation_age(as_of: Column, second_time: Column) -> Column:
    """Whole days between the issue date and the last acquisition."""
    return F.datediff(as_of, F.to_date(second_time))


def is_stale(age: Column, limit: int = MAX_AGE_DAYS) -> Column:
    return age > limit


def summary_text(
    synthetic: Column,
    status: Column,
    first_time: Column,
    second_time: Column,
    baseline_days: Column,
    ice_km2: Column,
    age: Column | None = None,
    gain_km2: Column | None = None,
    loss_km2: Column | None = None,
    common_km2: Column | None = None,
    since: Column | None = None,
) -> Column:
    """One paragraph about a product; the later arguments add staleness and change.

    ``common_km2`` NULL means that no comparable earlier product exists.
    """
    day = lambda t: F.date_format(t, "yyyy-MM-dd")
    one = lambda v: F.format_string("%.1f", v)
    # The wording of published summaries.
    test_only = "SYNTHETIC TEST DATA. This bulletin tests the software and layout; it describes no observed Davis conditions."
    segmented = " Texture segmentation is available; fast-ice extent, change and persistence cannot yet be reported because no trained classification was applied."
    unvalidated = " km² within the observed ocean domain. This is an unvalidated research classification."
    no_prior = " No comparable prior classification is available for change assessment."
    observed = F.concat(
        F.lit("Observations "), day(first_time), F.lit(" to "), day(second_time), F.lit(" ("), one(baseline_days), F.lit("-day baseline).")
    )
    text = F.when(synthetic, test_only).when(status == STATUS_SEGMENTED, F.concat(observed, F.lit(segmented))).otherwise(
        F.concat(observed, F.lit(" Candidate fast-ice coverage: "), one(ice_km2), F.lit(unvalidated))
    )
    if age is not None:
        stale = F.concat(
            F.lit(" Latest observation is "), age.cast("string"), F.lit(" days old; no current-conditions assessment is available.")
        )
        text = F.concat(text, F.when(is_stale(age), stale).otherwise(F.lit("")))
    if common_km2 is not None:
        changed = F.concat(
            F.lit(" On common observed coverage: gain "), one(gain_km2), F.lit(" km², loss "), one(loss_km2), F.lit(" km² since "), day(since), F.lit(".")
        )
        classified = status == STATUS_CLASSIFIED
        prior = F.when(classified & since.isNotNull() & common_km2.isNull(), no_prior).when(
            classified & (common_km2 > 0), changed
        )
        text = F.concat(text, F.coalesce(prior, F.lit("")))
    return text


def limitations(existing: Column, accepted_transfer: Column, class3_count: Column) -> Column:
    """Limitations of a product, extended by what its classifier implies; order kept, no repeats."""
    # The wording of published limitations.
    transfer = "Candidate model transfer: source preprocessing/station differs or is incompletely documented."
    single = "Melting-fast-ice class 3 has only one training segment; its performance is not established."
    added = F.array_compact(F.array(F.when(accepted_transfer, transfer), F.when(class3_count == 1, single)))
    return F.array_distinct(F.concat(F.coalesce(existing, F.array().cast("array<string>")), added))


def date_matched(products: DataFrame, first_date: Column, second_date: Column) -> DataFrame:
    """Products whose acquisition days equal the reference days."""
    return products.filter((F.to_date("first_time") == first_date) & (F.to_date("second_time") == second_date))


def declared_dates(path: Column) -> Column:
    """``yyyymmdd_yyyymmdd`` in a path, or NULL: names must not contradict the declared days."""
    found = F.regexp_extract(path, r"(\d{8}_\d{8})", 1)
    return F.when(found != "", found)


def conflicting_names(references: DataFrame) -> DataFrame:
    """References ``file_name, folder_name, first_date, second_date`` whose names declare other days."""
    declared = F.concat_ws("_", F.date_format("first_date", "yyyyMMdd"), F.date_format("second_date", "yyyyMMdd"))
    clash = lambda c: F.coalesce(declared_dates(F.col(c)) != declared, F.lit(False))
    return references.filter(clash("file_name") | clash("folder_name"))
