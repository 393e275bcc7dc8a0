import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from floe.session import prepare  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()


@pytest.fixture
def raster(spark):
    """Build a cell table from equal-shaped arrays (NaN is missing)."""
    import numpy as np

    def build(**bands):
        shape = next(iter(bands.values())).shape
        rows, cols = np.indices(shape)
        value = lambda v: None if not np.isfinite(v) else float(v)
        data = [
            ("s", int(r), int(c), shape[0], shape[1], *[value(b[r, c]) for b in bands.values()])
            for r, c in zip(rows.ravel(), cols.ravel())
        ]
        columns = ", ".join(f"{k} double" for k in bands)
        return spark.createDataFrame(data, f"scene_id string, row bigint, col bigint, height bigint, width bigint, {columns}")

    return build
