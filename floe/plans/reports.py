"""Issue reports: latest product, change since the previous comparable one, wording."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floe.operators.metrics import change_cells, change_metrics
from floe.operators.products import CONFIG_SECTIONS, comparable, latest_per_week, latest_product, observation_age, previous_product, summary_text
from floe.schema import STATUS_CLASSIFIED

_COMPARED = [*CONFIG_SECTIONS, "implementation_hash", "grid", "resource_hashes"]
_SHOWN = ["product_id", "first_time", "second_time", "synthetic", "status", "baseline_days", "ice_km2"]


def comparable_pairs(products: DataFrame) -> DataFrame:
    """Products with the previous one and whether a change between them may be reported."""
    linked = previous_product(products, ["product_id", "second_time", *_COMPARED])
    old, new = ({c: F.col(p + c) for c in _COMPARED} for p in ("prev_", ""))
    claim = (F.col("status") == STATUS_CLASSIFIED) & F.col("prev_product_id").isNotNull() & comparable(new, old)
    return linked.select("product_id", "prev_product_id", "prev_second_time", claim.alias("comparable"))


def pair_changes(pairs: DataFrame, cells: DataFrame) -> DataFrame:
    """Change areas for (product_id, prev_product_id); each pair is computed once, however often it is reported.

    ``cells``: ``product_id, row, col, cls, area_km2``. They are read once: a cell takes the pairs its product stands in,
    as the newer or the older side, and the two sides of a cell meet in one partial aggregate.
    """
    ids = ["product_id", "prev_product_id"]
    wanted = pairs.select(*ids).distinct()
    side = lambda own, newer: F.struct(F.col(own).alias("own"), F.lit(newer).alias("newer"))
    roles = wanted.select(*ids, F.inline(F.array(side("product_id", True), side("prev_product_id", False))))
    shown = cells.select(F.col("product_id").alias("own"), "row", "col", "cls", "area_km2").filter("cls is not null")
    newer, code = F.col("newer"), lambda on: F.max(F.when(on, F.col("cls")))
    both = shown.join(roles, "own").groupBy(*ids, "row", "col").agg(
        code(newer).alias("curr"), code(~newer).alias("prev"), F.max(F.when(newer, F.col("area_km2"))).alias("area_km2")
    )
    return change_metrics(change_cells(both.filter("curr is not null and prev is not null")), ids)


def report_rows(current: DataFrame, products: DataFrame, cells: DataFrame) -> DataFrame:
    """One report per row of ``current`` (``region, issue_date`` and product columns)."""
    links = comparable_pairs(products)
    issued = current.join(links, "product_id")
    changes = pair_changes(issued.filter("comparable"), cells)
    areas = ("gain_km2", "loss_km2", "persistent_km2", "net_km2", "common_km2")
    full = issued.join(changes, ["product_id", "prev_product_id"], "left")
    # comparable products that share no observed cell have a change of nothing, not a missing one
    full = full.withColumns({c: F.when(F.col("comparable"), F.coalesce(c, F.lit(0.0))) for c in areas})
    age = observation_age(F.col("issue_date"), F.col("second_time"))
    text = summary_text(
        F.col("synthetic"),
        F.col("status"),
        F.col("first_time"),
        F.col("second_time"),
        F.col("baseline_days"),
        F.col("ice_km2"),
        age,
        F.col("gain_km2"),
        F.col("loss_km2"),
        F.col("common_km2"),
        F.col("prev_second_time"),
    )
    return full.select(
        "region", "issue_date", "product_id", F.when(F.col("comparable"), F.col("prev_product_id")).alias("compared_with"),
        age.alias("age_days"), "gain_km2", "loss_km2", "persistent_km2", "net_km2", "common_km2", text.alias("summary"),
    )


def issue_report(products: DataFrame, cells: DataFrame, as_of: str) -> DataFrame:
    """Reports of all regions for one issue date."""
    current = latest_product(products.select("region", *_SHOWN, "created_time"), as_of)
    return report_rows(current.withColumn("issue_date", F.lit(as_of).cast("date")), products, cells)


def season_reports(products: DataFrame, cells: DataFrame, start_year: int, start_month: int = 9, end_month: int = 4) -> DataFrame:
    """Reports of all regions for every weekly issue of a season, in one query."""
    current = latest_per_week(products, start_year, start_month, end_month, columns=_SHOWN)
    return report_rows(current, products, cells)
