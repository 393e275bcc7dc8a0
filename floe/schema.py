"""Code sets, palettes, defaults and schemas shared by all operators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Class codes of a classification grid.
OCEAN, EXCLUDED, FAST_ICE, MELT_ICE, UNKNOWN = 0, 1, 2, 3, 255
CLASS_CODES = (0, 1, 2, 3, 255)
TRAIN_CODES = (0, 2, 3)
ICE_CODES = (2, 3)

# Change codes (0 ocean in both, 1 persistent ice, 2 gain, 3 loss, 255 unavailable).
CHANGE_CODES = (0, 1, 2, 3, 255)

# Display colours.
PALETTE = {0: (15, 35, 48), 1: (88, 94, 99), 2: (68, 218, 100), 3: (240, 170, 40)}
PALETTE_DEFAULT = (235, 235, 235)

# Polygon surfaces that count as land or floating shelf.
SURFACES = ("land", "ice shelf", "ice tongue", "rumple")

# Names and texts that published products carry.
FEATURES = "mean_RGB_uint8"
STATUS_CLASSIFIED = "candidate_classification"
STATUS_SEGMENTED = "segmentation_only"

TEXTURE_WINDOWS = (11, 21, 33)
MIN_VALID_FRACTION = 0.8
DEFAULT_TILE = 512
POLAR_CRS = "EPSG:3031"

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
RING = T.ArrayType(POINT)

SCENE = T.StructType(
    [
        T.StructField("file_id", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("stop_time", T.TimestampType()),
        T.StructField("platform", T.StringType()),
        T.StructField("path_number", T.LongType()),
        T.StructField("flight_direction", T.StringType()),
        T.StructField("beam_mode", T.StringType()),
        T.StructField("polarization", T.StringType()),
        T.StructField("processing_level", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("footprint", RING),
    ]
)


@dataclass(frozen=True)
class Affine:
    """Grid transform: x = c + col*a + row*b, y = f + col*d + row*e."""

    a: float
    b: float
    c: float
    d: float
    e: float
    f: float

    @classmethod
    def north_up(cls, left: float, top: float, size: float) -> "Affine":
        return cls(size, 0.0, left, 0.0, -size, top)


@dataclass(frozen=True)
class Grid:
    """One raster frame: reference system, transform and shape."""

    transform: Affine
    height: int
    width: int
    crs: str = POLAR_CRS


@dataclass(frozen=True)
class PairRules:
    """Which acquisitions may form a pair."""

    polarization: str = "HH"
    min_days: float = 3.0
    max_days: float = 24.0
    min_overlap: float = 0.25

    def __post_init__(self) -> None:
        if not 0 < self.min_days <= self.max_days:
            raise ValueError("need 0 < min_days <= max_days")
        if not 0 < self.min_overlap <= 1:
            raise ValueError("min_overlap must lie in (0, 1]")
        if self.polarization not in ("HH", "VV"):
            raise ValueError("polarization must be co-polar: HH or VV")
