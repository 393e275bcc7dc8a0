"""Cell-local maps: units, masks, display codes and class codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floe.schema import CLASS_CODES, ICE_CODES, PALETTE, PALETTE_DEFAULT, TRAIN_CODES, UNKNOWN


def clean(value: Column) -> Column:
    """NaN never enters the engine: missing is NULL."""
    return F.when(~F.isnan(value), value)


def to_db(value: Column, units: str = "linear_power") -> Column:
    """Backscatter in decibels; linear power at or below zero is missing."""
    if units == "db":
        return clean(value)
    if units != "linear_power":
        raise ValueError("units must be 'db' or 'linear_power'")
    return F.when(clean(value) > 0, 10 * F.log10(value))


def apply_mask(value: Column, excluded: Column) -> Column:
    """Excluded cells turn missing, so they lower the local valid fraction."""
    return F.when(~F.coalesce(excluded, F.lit(False)), value)


def texture_valid(*bands: Column) -> Column:
    valid = F.lit(True)
    for band in bands:
        valid = valid & band.isNotNull()
    return valid


def encode_band(band: Column, valid: Column) -> Column:
    """Texture in [-0.5, 1] to 0..255, half to even, clipped; 0 where the cell is invalid."""
    unit = F.least(F.greatest((band + 0.5) / 1.5, F.lit(0.0)), F.lit(1.0))
    return F.when(valid, F.rint(unit * 255).cast("smallint")).otherwise(F.lit(0).cast("smallint"))


def encode_rgb(df: DataFrame, t1: str = "t1", t2: str = "t2", t3: str = "t3") -> DataFrame:
    """Three texture scales to r, g, b plus a validity flag (valid black differs from missing)."""
    bands = [F.col(c) for c in (t1, t2, t3)]
    valid = texture_valid(*bands)
    return df.withColumns(
        {"valid": valid, **{name: encode_band(band, valid) for name, band in zip("rgb", bands)}}
    )


def validity_code(valid: Column, excluded: Column) -> Column:
    """0 unobserved, 1 valid, 2 excluded; exclusion wins."""
    return F.when(excluded, 2).when(valid, 1).otherwise(0).cast("smallint")


def final_class(predicted: Column, segment_id: Column, valid: Column, excluded: Column) -> Column:
    """Order of precedence: excluded 1, then invalid or unassigned 255, then the segment's class."""
    return (
        F.when(excluded, 1)
        .when(~valid | (segment_id == 0), UNKNOWN)
        .otherwise(F.coalesce(predicted, F.lit(UNKNOWN)))
        .cast("smallint")
    )


def bad_code(code: Column) -> Column:
    """True for a code outside the closed class set (NULL is bad too)."""
    return ~F.coalesce(code.isin(*CLASS_CODES), F.lit(False))


def assert_codes(df: DataFrame, column: str = "cls") -> DataFrame:
    """Fail the job on the first cell with an unknown class code, at no extra pass."""
    message = F.concat(F.lit("unknown class code: "), F.col(column).cast("string"))
    return df.withColumn(column, F.when(bad_code(F.col(column)), F.raise_error(message)).otherwise(F.col(column)))


def unknown_codes(df: DataFrame, column: str = "cls") -> DataFrame:
    """Offending codes with their cell counts; empty when the grid is sound."""
    return df.filter(bad_code(F.col(column))).groupBy(column).agg(F.count("*").alias("cells"))


def is_fast_ice(code: Column) -> Column:
    return F.coalesce(code.isin(*ICE_CODES), F.lit(False))


def is_observed_ocean(code: Column) -> Column:
    return F.coalesce(code.isin(*TRAIN_CODES), F.lit(False))


def composite_rgba(df: DataFrame) -> DataFrame:
    """Texture colours with excluded cells painted and missing cells transparent."""
    paint = PALETTE[1]
    channels = {
        name: F.when(F.col("excluded"), F.lit(value)).otherwise(F.col(name)).cast("smallint")
        for name, value in zip("rgb", paint)
    }
    alpha = F.when(F.col("valid") | F.col("excluded"), 255).otherwise(0).cast("smallint")
    return df.withColumns({**channels, "alpha": alpha})


def class_rgba(df: DataFrame, column: str = "cls") -> DataFrame:
    """Display colour per class; only 255 is transparent. A literal lookup, so no join."""

    def channel(k: int) -> Column:
        value = F.lit(PALETTE_DEFAULT[k])
        for code, colour in PALETTE.items():
            value = F.when(F.col(column) == code, colour[k]).otherwise(value)
        return value.cast("smallint")

    alpha = F.when(F.col(column) == UNKNOWN, 0).otherwise(255).cast("smallint")
    return df.withColumns({"r": channel(0), "g": channel(1), "b": channel(2), "alpha": alpha})


def label_template(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Same grid, every cell unlabelled."""
    return cells.select(*keys, F.lit(UNKNOWN).cast("smallint").alias("label"))


def usable_label(label: Column, validity: Column, segment_id: Column) -> Column:
    """Manual labels: missing is 255; invalid cells and background are 255; other codes fail."""
    filled = F.coalesce(label, F.lit(UNKNOWN))
    illegal = ~filled.isin(*TRAIN_CODES, UNKNOWN)
    return (
        F.when(illegal, F.raise_error(F.concat(F.lit("illegal label: "), filled.cast("string"))))
        .when((validity != 1) | (segment_id == 0), UNKNOWN)
        .otherwise(filled)
        .cast("smallint")
    )
