"""Scenes, grids, segments, polygons and products derived from the given tables.

The statements are portable; ``{table}`` marks an input. Where the engines differ
(array explosion, hashing) both spellings are listed.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from floe.schema import Affine

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

# The grid over which class codes lie: 40 m cells on the polar map.
CLASS_AFFINE = Affine.north_up(2289600.0, 503520.0, 40.0)
# One map unit per cell, x = column and y = row, for outlines drawn in cell units.
UNIT_AFFINE = Affine(1.0, 0.0, 0.0, 0.0, 1.0, 0.0)
DAVIS = (75.5, -69.2, 80.5, -67.3)

_SHARED = {
    "fx_cat": """
SELECT event_id AS file_id, ts AS start_time, ts + INTERVAL 64 SECOND AS stop_time,
  CASE WHEN user_id % 2 = 0 THEN 'S1A' ELSE 'S1B' END AS mission,
  CASE WHEN event_id % 211 = 0 THEN NULL ELSE user_id END AS path_number,
  CASE WHEN event_id % 3 = 0 THEN 'ASCENDING' ELSE 'DESCENDING' END AS flight_direction,
  event_type AS beam_mode,
  CASE WHEN user_id % 5 = 0 THEN 'VV+VH' ELSE 'HH+HV' END AS polarization,
  73e0 + (event_id % 40) / 10e0 AS west, 77e0 + (event_id % 40) / 10e0 AS east,
  -70e0 + (event_id % 20) / 10e0 AS south, -68e0 + (event_id % 20) / 10e0 AS north
FROM {events}""",
    "fx_ann": """
SELECT scene_id, segment_id,
  CASE (scene_id + segment_id) % 5 WHEN 0 THEN 0 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 1 ELSE NULL END AS label
FROM {fx_slots}""",
    "fx_annseg": """
SELECT s.scene_id, s.segment_id, (d.n_chars + 7 * s.segment_id) % 256 AS r,
  (d.n_chars + 31 * s.segment_id) % 256 AS g, (s.scene_id + 11 * s.segment_id) % 256 AS b
FROM {fx_slots} s JOIN {documents} d ON d.doc_id = s.scene_id
WHERE s.segment_id <= d.n_chars % 12""",
    "fx_cls": """
SELECT l_orderkey % 1000 AS row, l_partkey % 100 AS col,
  CASE WHEN (l_orderkey % 1000 + l_partkey % 100) % 17 = 0 THEN 1
       WHEN min(l_linestatus) = 'O' AND max(l_linenumber) > 6 THEN 255
       WHEN min(l_returnflag) = 'A' THEN 0 WHEN min(l_returnflag) = 'N' THEN 2 ELSE 3 END AS prev,
  CASE WHEN (l_orderkey % 1000 + l_partkey % 100) % 17 = 0 THEN 1
       WHEN max(l_quantity) < 5 THEN 255 WHEN max(l_quantity) < 25 THEN 0
       WHEN max(l_quantity) < 40 THEN 2 ELSE 3 END AS curr
FROM {lineitem}
GROUP BY l_orderkey % 1000, l_partkey % 100""",
    "fx_val": """
SELECT row, col, curr AS cls, CASE WHEN curr = 255 THEN 0 WHEN curr = 1 THEN 2 ELSE 1 END AS validity,
  row BETWEEN 100 AND 900 AS in_domain, (row + col) % 4 < 2 AS in_reference
FROM {fx_cls}""",
    "fx_prod": """
SELECT o_orderkey AS product_id, concat('R', CAST(o_custkey % 25 AS VARCHAR(10))) AS region,
  o_orderdate - INTERVAL 12 DAY AS first_time, o_orderdate AS second_time, o_orderdate + INTERVAL 3 DAY AS created_time,
  o_orderkey % 10 = 0 AS synthetic,
  CASE WHEN o_orderstatus = 'P' THEN 'segmentation_only' ELSE 'candidate_classification' END AS status,
  o_orderpriority AS config_hash, o_totalprice AS ice_km2,
  concat('texture-', CAST(o_custkey % 2 AS VARCHAR(10))) AS processing,
  concat('grid-', CAST(o_orderkey % 3 AS VARCHAR(10))) AS segmentation,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'model-a' END AS classifier,
  'mask-7' AS coastline, concat('h', CAST(o_custkey % 3 AS VARCHAR(10))) AS mask_hash,
  CASE WHEN o_orderkey % 50 = 0 THEN 'code-2' ELSE 'code-1' END AS implementation_hash,
  1000 + (o_custkey % 2) AS grid_height
FROM {orders}""",
    "fx_dem": """
SELECT row, col, (row + col) % 3 = 0 AS land, CASE WHEN (row + col) % 3 = 0 THEN coalesce(a, 100) ELSE a END AS terrain,
  CASE WHEN row % 211 = 3 THEN NULL ELSE 18000 + row % 7 END AS geoid
FROM {fx_grid}""",
    # three rasters of different shape: the upper half whole, the lower half cut in two at column 40
    "fx_site": """
SELECT CASE WHEN row < half THEN 0 WHEN col < 40 THEN 1 ELSE 2 END AS scene_id, CASE WHEN row < half THEN row ELSE row - half END AS row,
  CASE WHEN row >= half AND col >= 40 THEN col - 40 ELSE col END AS col, a, b
FROM (SELECT row, col, a, b, (SELECT CAST(floor((max(vec_id) + 1) / 2e0) AS BIGINT) FROM {embeddings}) AS half FROM {fx_grid}) g""",
    "fx_fold": """
SELECT scene_no, region AS fold, label, CASE WHEN f1 % 5 = 0 THEN 3 WHEN f1 % 2 = 0 THEN 0 ELSE 2 END AS pred
FROM {fx_doc}
WHERE label IS NOT NULL""",
    # one five-cornered, partly concave outline per supplier, in (column, row) units
    "fx_outline": """
SELECT s_suppkey AS poly_id,
  CASE s_suppkey % 6 WHEN 0 THEN 'land' WHEN 1 THEN 'ice shelf' WHEN 2 THEN 'ice tongue' WHEN 3 THEN 'rumple' WHEN 4 THEN 'ocean' ELSE 'land' END AS surface,
  CAST((s_suppkey * 7) % 50 AS DOUBLE) AS x0, CAST((s_suppkey * 37) % 470 AS DOUBLE) AS y0, CAST(4 + s_suppkey % 9 AS DOUBLE) AS size
FROM {supplier}""",
    "fx_box": """
SELECT c_custkey AS box_id, -179e0 + (c_custkey * 13) % 340 AS west, -179e0 + (c_custkey * 13) % 340 + 2 + c_custkey % 7 AS east,
  -80e0 + c_custkey % 15 AS south, -79e0 + c_custkey % 15 + (c_custkey % 4) / 2e0 AS north
FROM {customer}""",
    # repeat imagery of a region: every order is a scene taken on two days twelve days apart
    "fx_repeat": """
SELECT o_orderkey AS scene_id, concat('site', CAST(o_custkey % 5 AS VARCHAR(10))) AS region,
  CAST(o_orderdate AS DATE) AS first_date, CAST(o_orderdate AS DATE) + INTERVAL 12 DAY AS second_date
FROM {orders}""",
    # class cells of products: one row of cells per product
    "fx_prodcell": """
SELECT l_orderkey AS product_id, l_linenumber AS row, l_orderkey % 1 AS col,
  min(CASE WHEN l_quantity < 5 THEN 255 WHEN l_quantity < 8 THEN 1 WHEN l_quantity < 25 THEN 0 WHEN l_quantity < 40 THEN 2 ELSE 3 END) AS cls
FROM {lineitem}
GROUP BY l_orderkey, l_linenumber""",
    # overlapping segment masks over cells
    "fx_mask": """
SELECT l_suppkey % 40 AS mask_id, l_orderkey % 500 AS row, l_partkey % 64 AS col, 10 + (l_suppkey % 40) % 7 AS area
FROM {lineitem}""",
    "fx_run": """
SELECT p_partkey AS run_id,
  CASE WHEN p_partkey % 13 = 0 THEN 'bad name!' WHEN p_partkey % 29 = 0 THEN '--' ELSE 'Davis_1' END AS region,
  75.5e0 AS west, CASE WHEN p_partkey % 11 = 0 THEN 70e0 ELSE 80.5e0 END AS east, -69.2e0 AS south,
  CASE WHEN p_partkey % 31 = 0 THEN 95e0 ELSE -67.3e0 END AS north,
  CAST('2021-10-01' AS DATE) AS start_date,
  CASE WHEN p_partkey % 7 = 0 THEN CAST('2021-09-01' AS DATE) ELSE CAST('2021-10-31' AS DATE) END AS end_date,
  CAST(p_size % 5 AS DOUBLE) AS min_days, 3e0 AS max_days, (p_partkey % 9) / 4e0 AS min_overlap,
  CASE p_partkey % 3 WHEN 0 THEN 'HH' WHEN 1 THEN 'VV' ELSE 'HV' END AS polarization,
  p_size - 3e0 AS resolution, 32 * (p_partkey % 4) AS tile_size,
  CASE WHEN p_partkey % 2 = 0 THEN 'db' ELSE 'linear_power' END AS input_units,
  9 + p_partkey % 5 AS w1, 21 AS w2, 33 AS w3
FROM {part}""",
}

# engine-specific spellings: (Spark, DuckDB)
_SPECIFIC = {
    "fx_dense": (
        """
SELECT vec_id AS row, CAST(p.pos AS BIGINT) AS col, CAST(floor(CAST(p.col AS DOUBLE) * 1000) AS BIGINT) AS v, label
FROM {embeddings} LATERAL VIEW posexplode(embedding) p AS pos, col""",
        """
SELECT row, col, CAST(floor(CAST(embedding[col + 1] AS DOUBLE) * 1000) AS BIGINT) AS v, label
FROM (SELECT vec_id AS row, unnest(range(64)) AS col, embedding, label FROM {embeddings}) t""",
    ),
    "fx_grid": (
        """
SELECT x.row AS row, x.col AS col,
  CASE WHEN x.row < 5 OR (x.row % 97 = 0 AND x.col BETWEEN 10 AND 20) THEN NULL ELSE x.v END AS a,
  CASE WHEN x.row < 5 OR (x.row % 97 = 0 AND x.col BETWEEN 10 AND 20) THEN NULL
       WHEN x.col < 32 THEN x.v ELSE coalesce(n.v, 0) END AS b,
  x.label AS label
FROM {fx_dense} x LEFT JOIN {fx_dense} n ON n.row = x.row + 1 AND n.col = x.col""",
        """
SELECT row, col,
  CASE WHEN row < 5 OR (row % 97 = 0 AND col BETWEEN 10 AND 20) THEN NULL ELSE v END AS a,
  CASE WHEN row < 5 OR (row % 97 = 0 AND col BETWEEN 10 AND 20) THEN NULL
       WHEN col < 32 THEN v ELSE coalesce(lead(v) OVER (PARTITION BY col ORDER BY row), 0) END AS b,
  label
FROM {fx_dense}""",
    ),
    "fx_seg": (
        """
SELECT row, CAST(col AS BIGINT) AS col, row % 10 AS scene_id, CAST(label AS BIGINT) AS segment_id,
  least(greatest(128 + CAST(floor(floor(CAST(x AS DOUBLE) * 1000) / 2e0) AS BIGINT), 0), 255) AS r,
  least(greatest(128 + CAST(floor(floor(CAST(y AS DOUBLE) * 1000) / 2e0) AS BIGINT), 0), 255) AS g,
  least(greatest(128 + CAST(floor(floor(CAST(z AS DOUBLE) * 1000) / 2e0) AS BIGINT), 0), 255) AS b
FROM (SELECT vec_id AS row, p.pos AS col, p.col AS x, get(embedding, p.pos + 1) AS y, get(embedding, p.pos + 2) AS z, label
      FROM {embeddings} LATERAL VIEW posexplode(embedding) p AS pos, col)
WHERE col < 62""",
        """
SELECT x.row AS row, x.col AS col, x.row % 10 AS scene_id, CAST(x.label AS BIGINT) AS segment_id,
  least(greatest(128 + CAST(floor(x.v / 2e0) AS BIGINT), 0), 255) AS r,
  least(greatest(128 + CAST(floor(y.v / 2e0) AS BIGINT), 0), 255) AS g,
  least(greatest(128 + CAST(floor(z.v / 2e0) AS BIGINT), 0), 255) AS b
FROM {fx_dense} x JOIN {fx_dense} y ON y.row = x.row AND y.col = x.col + 1
JOIN {fx_dense} z ON z.row = x.row AND z.col = x.col + 2""",
    ),
    # five corners per outline
    "fx_vertex": (
        """
SELECT o.poly_id, o.surface, c.seq, o.x0 + c.dx * o.size AS x, o.y0 + c.dy * o.size AS y
FROM {fx_outline} o
LATERAL VIEW inline(array(struct(0, 0e0, 0e0), struct(1, 1e0, 0e0), struct(2, 1e0, 2e0), struct(3, 5e-1, 1e0), struct(4, 0e0, 2e0))) c AS seq, dx, dy""",
        """
SELECT o.poly_id, o.surface, c.seq, o.x0 + c.dx * o.size AS x, o.y0 + c.dy * o.size AS y
FROM {fx_outline} o
CROSS JOIN (VALUES (0, 0e0, 0e0), (1, 1e0, 0e0), (2, 1e0, 2e0), (3, 5e-1, 1e0), (4, 0e0, 2e0)) AS c(seq, dx, dy)""",
    ),
    "fx_orb": (
        """
SELECT concat(m.mission, '_OPER_AUX_POEORB_OPOD_', CAST(m.k AS VARCHAR(4)), '_', CAST(d.day AS VARCHAR(32))) AS name,
  m.mission AS mission, d.day + INTERVAL 20 DAY + m.k * INTERVAL 1 HOUR AS creation,
  d.day - INTERVAL 3618 SECOND AS valid_from, d.day + INTERVAL 89982 SECOND AS valid_to, m.k AS issue, d.day AS day
FROM (SELECT DISTINCT date_trunc('day', ts) AS day FROM {events}) d
LATERAL VIEW inline(array(struct('S1A', 0), struct('S1A', 1), struct('S1B', 0))) m AS mission, k
WHERE NOT (m.mission = 'S1B' AND day(d.day) IN (10, 11))""",
        """
SELECT concat(m.mission, '_OPER_AUX_POEORB_OPOD_', CAST(m.k AS VARCHAR(4)), '_', CAST(d.day AS VARCHAR(32))) AS name,
  m.mission AS mission, d.day + INTERVAL 20 DAY + m.k * INTERVAL 1 HOUR AS creation,
  d.day - INTERVAL 3618 SECOND AS valid_from, d.day + INTERVAL 89982 SECOND AS valid_to, m.k AS issue, d.day AS day
FROM (SELECT DISTINCT date_trunc('day', ts) AS day FROM {events}) d
CROSS JOIN (VALUES ('S1A', 0), ('S1A', 1), ('S1B', 0)) AS m(mission, k)
WHERE NOT (m.mission = 'S1B' AND day(d.day) IN (10, 11))""",
    ),
    "fx_slots": (
        "SELECT doc_id AS scene_id, CAST(s AS BIGINT) AS segment_id FROM {documents} LATERAL VIEW explode(sequence(0, 11)) t AS s",
        "SELECT doc_id AS scene_id, CAST(unnest(range(12)) AS BIGINT) AS segment_id FROM {documents}",
    ),
    "fx_doc": (
        """
SELECT d.doc_id AS scene_no, d.lang AS region, d.source AS scene_group, sha2(d.text, 256) AS image_hash, d.n_chars AS f1,
  l.quality * 2 AS label
FROM {documents} d LEFT JOIN {labels} l ON l.doc_id = d.doc_id""",
        """
SELECT d.doc_id AS scene_no, d.lang AS region, d.source AS scene_group, sha256(d.text) AS image_hash, d.n_chars AS f1,
  l.quality * 2 AS label
FROM {documents} d LEFT JOIN {labels} l ON l.doc_id = d.doc_id""",
    ),
}

# A scene is a million raster rows; an outline belongs to the scene of its id's billion. The ids come from
# the data, for a constant would drop out of the partitioning keys.
SCENE_ROWS, SCENE_OUTLINES = 10**6, 10**9


def scene_of(column: str, span: int = SCENE_ROWS) -> Column:
    return F.floor(F.col(column) / span).alias("scene_id")


SPARK = {**_SHARED, **{k: v[0] for k, v in _SPECIFIC.items()}}
DUCK = {k: re.sub(r"\{(\w+)\}", r"\1", v) for k, v in {**_SHARED, **{k: v[1] for k, v in _SPECIFIC.items()}}.items()}


class Tables:
    """Given tables and derived fixtures of one data folder as attributes, all lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        self._known: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._known:
            self._known[name] = self._load(name)
        return self._known[name]

    def _load(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name not in SPARK:
            raise AttributeError(name)
        inputs = {n: getattr(self, n) for n in set(re.findall(r"\{(\w+)\}", SPARK[name]))}
        return self.spark.sql(SPARK[name], **inputs)

    def shape(self) -> DataFrame:
        """Height of the raster pair as one row, from a column-pruned scan."""
        return self.embeddings.agg((F.max("vec_id") + 1).alias("height"))

    def raster(self) -> DataFrame:
        """The raster pair with its scene id and shape."""
        return self.fx_grid.select(
            scene_of("row"), "row", "col", "a", "b", self.shape().scalar().alias("height"), F.lit(64).cast("bigint").alias("width")
        )

    def grid(self) -> DataFrame:
        """Scene id and shape of the raster pair."""
        return self.shape().select(F.floor((F.col("height") - 1) / SCENE_ROWS).alias("scene_id"), "height", F.lit(64).cast("bigint").alias("width"))
