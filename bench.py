"""Headline queries, timed.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores. Prints one
JSON line. ``texture_cells_per_sec`` is the tile route on a synthetic raster of
``BENCH_CELLS`` cells (10 million unless set; 0 leaves it out).
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from floe.operators.cells import cells_to_tiles
from floe.operators.focal import texture_tiles
from floe.queries import QUERIES
from floe.session import prepare, shared_dir
from floe.sources.rasters import synthetic_pair

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
CELLS = int(os.environ.get("BENCH_CELLS", "10000000"))

HEADLINE = (
    "j1_compatible_pairs j3_orbit_coverage j4_polygon_mask j8_paint_segments j11_duplicate_scenes j13_previous_product j19_regrid_bilinear j21_downsample_nearest "
    "w1_masked_mean w2_normprod w3_texture_tiles p3_encode_rgb p15_cell_area a1_segment_features a4_extent_metrics a5_change_metrics a6_outline_assessment "
    "a12_elevation_percentiles g1_acquisition_groups g2_logo_predictions g5_classify_cells g7_superpixels t1_weekly_series b1_discover_pairs b2_pair_product b8_season_reports"
).split()


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("floe-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(make) -> float:
    start = time.perf_counter()
    drain(make())
    return round(time.perf_counter() - start, 3)


def texture_rate(spark: SparkSession) -> dict[str, float]:
    """Cells per second of the texture at three widths over stored tiles."""
    side = int(CELLS**0.5)
    path = f"{shared_dir(spark)}/bench-tiles"
    cells_to_tiles(synthetic_pair(spark, side, side, 1), 256, ["a", "b"]).write.mode("overwrite").parquet(path)
    seconds = timed(lambda: texture_tiles(spark.read.parquet(path), (11, 21, 33), tile=256))
    return {"texture_synthetic_sec": seconds, "texture_cells_per_sec": round(side * side / seconds)}


def main() -> None:
    spark = session()
    # start-up of the JVM and of the Python workers is not part of any query
    for name in ("a5_change_metrics", "w3_texture_tiles"):
        drain(QUERIES[name](spark, SF_DIR))
    seconds = {name: timed(lambda name=name: QUERIES[name](spark, SF_DIR)) for name in HEADLINE}
    record = {"metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(SF_DIR.rstrip("/"))}
    if CELLS:
        record.update(texture_rate(spark))
    print(json.dumps(record))


if __name__ == "__main__":
    main()
