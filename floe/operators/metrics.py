"""Extent, change and outline metrics. Unknown cells never count as retreat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floe.functions.encode import is_fast_ice, is_observed_ocean
from floe.schema import TRAIN_CODES, UNKNOWN


def _area_where(condition: Column, area: str = "area_km2") -> Column:
    return F.sum(F.when(condition, F.col(area)).otherwise(0.0))


def extent_metrics(cells: DataFrame, keys: list[str], cls: str = "cls", extra: list[Column] | None = None) -> DataFrame:
    """Ice and observed ocean in km2, and the number of unknown cells; ``extra`` aggregates share the pass."""
    code = F.col(cls)
    return cells.groupBy(*keys).agg(
        _area_where(is_fast_ice(code)).alias("ice_km2"),
        _area_where(is_observed_ocean(code)).alias("observed_km2"),
        F.sum(F.when(code == UNKNOWN, 1).otherwise(0)).alias("unknown_cells"),
        *(extra or []),
    )


def change_code(prev: Column, curr: Column) -> Column:
    """0 ocean both times, 1 persistent ice, 2 gain, 3 loss, 255 where either is not observed."""
    common = is_observed_ocean(prev) & is_observed_ocean(curr)
    old, new = is_fast_ice(prev), is_fast_ice(curr)
    return (
        F.when(~common, UNKNOWN).when(old & new, 1).when(new, 2).when(old, 3).otherwise(0).cast("smallint")
    )


def change_cells(cells: DataFrame, prev: str = "prev", curr: str = "curr") -> DataFrame:
    return cells.withColumn("change", change_code(F.col(prev), F.col(curr)))


def change_metrics(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Areas of a change grid over cells observed at both times."""
    code = F.col("change")
    sums = cells.groupBy(*keys).agg(
        _area_where(code != UNKNOWN).alias("common_km2"),
        _area_where(code == 2).alias("gain_km2"),
        _area_where(code == 3).alias("loss_km2"),
        _area_where(code == 1).alias("persistent_km2"),
    )
    return sums.withColumn("net_km2", F.col("gain_km2") - F.col("loss_km2"))


def overlay(cells: DataFrame) -> DataFrame:
    """Flags ``ocean`` and ``assessed`` for cells with ``cls, validity, in_domain``."""
    ocean = F.col("in_domain") & (F.col("validity") != 2) & (F.col("cls") != 1)
    assessed = ocean & (F.col("validity") == 1) & is_observed_ocean(F.col("cls"))
    return cells.withColumns({"ocean": ocean, "assessed": assessed})


def outline_assessment(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Area-weighted binary confusion of ``overlay`` cells against ``in_reference``.

    Ratios are NULL where their denominator is 0; ``problem`` says why nothing was assessed.
    """
    hit, ref, used = is_fast_ice(F.col("cls")), F.col("in_reference"), F.col("assessed")
    sums = cells.groupBy(*keys).agg(
        _area_where(used & hit & ref).alias("tp_km2"),
        _area_where(used & hit & ~ref).alias("fp_km2"),
        _area_where(used & ~hit & ref).alias("fn_km2"),
        _area_where(used & ~hit & ~ref).alias("tn_km2"),
        _area_where(F.col("ocean")).alias("ocean_km2"),
        _area_where(F.col("ocean") & ~used).alias("unassessed_km2"),
        F.bool_or("in_domain").alias("domain_hit"),
        F.bool_or(used).alias("any_assessed"),
    )
    tp, fp, fn = F.col("tp_km2"), F.col("fp_km2"), F.col("fn_km2")
    return sums.withColumns(
        {
            "precision": F.try_divide(tp, tp + fp),
            "recall": F.try_divide(tp, tp + fn),
            "iou": F.try_divide(tp, tp + fp + fn),
            "problem": F.when(~F.col("domain_hit"), "domain outside grid").when(~F.col("any_assessed"), "nothing assessed"),
        }
    ).drop("domain_hit", "any_assessed")


def confusion(rows: DataFrame, fold: str = "fold") -> DataFrame:
    """The full 3x3 matrix per fold, zero rows included, from one conditional aggregate."""
    cells = [(t, p) for t in TRAIN_CODES for p in TRAIN_CODES]
    counts = rows.groupBy(fold).agg(
        *[F.count(F.when((F.col("label") == t) & (F.col("pred") == p), 1)).alias(f"n_{t}_{p}") for t, p in cells]
    )
    entry = lambda t, p: F.struct(
        F.lit(t).cast("bigint").alias("label"), F.lit(p).cast("bigint").alias("pred"), F.col(f"n_{t}_{p}").alias("segments")
    )
    return counts.select(fold, F.inline(F.array(*[entry(t, p) for t, p in cells])))


def balanced_accuracy(rows: DataFrame, fold: str = "fold") -> DataFrame:
    """Mean recall over the classes that truly occur in a fold."""
    per_class = rows.groupBy(fold, "label").agg(F.avg(F.when(F.col("label") == F.col("pred"), 1.0).otherwise(0.0)).alias("recall"))
    return per_class.groupBy(fold).agg(F.avg("recall").alias("balanced_accuracy"), F.count("*").alias("classes"))
