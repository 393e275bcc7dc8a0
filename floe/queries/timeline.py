"""Products over time: latest, previous, comparable, weekly series, reuse and review."""

from pyspark.sql import functions as F

from floe.operators import products as P
from floe.operators.checks import numbered
from floe.queries.fixtures import Tables
from floe.queries.registry import day, query
from floe.streaming.incremental import plan_work

_ORDER = "second_time DESC, first_time DESC, created_time DESC, product_id DESC"


_ORDERED = ["second_time", "first_time", "created_time", "product_id"]


@query("o3_product_order", f"SELECT product_id, CAST(row_number() OVER (ORDER BY second_time, first_time, created_time, product_id) AS BIGINT) AS position FROM fx_prod")
def o3(t: Tables):
    """The whole ordered list, numbered."""
    return numbered(t.fx_prod.select(*_ORDERED), "second_time", _ORDERED).select("product_id", "position")


@query(
    "j12_latest_product",
    f"SELECT region, product_id FROM (SELECT *, row_number() OVER (PARTITION BY region ORDER BY {_ORDER}) AS k FROM fx_prod WHERE second_time <= TIMESTAMP '1998-06-01 23:59:59') WHERE k = 1",
)
def j12(t: Tables):
    return P.latest_product(t.fx_prod, "1998-06-01").select("region", "product_id")


@query(
    "w6_ranked_products",
    f"SELECT region, status, product_id FROM (SELECT *, row_number() OVER (PARTITION BY region, status ORDER BY {_ORDER}) AS k FROM fx_prod) WHERE k = 1",
)
def w6(t: Tables):
    """Winner rows per group with the documented tie-breaks."""
    best = F.max_by("product_id", F.struct(*P.ORDER))
    return t.fx_prod.groupBy("region", "status").agg(best.alias("product_id"))



@query(
    "j13_previous_product",
    """
WITH s AS (SELECT region, synthetic, status, second_time, max(product_id) AS top FROM fx_prod GROUP BY ALL),
l AS (SELECT *, lag(top) OVER (PARTITION BY region, synthetic, status ORDER BY second_time) AS prev_product_id FROM s)
SELECT p.product_id, l.prev_product_id FROM fx_prod p JOIN l USING (region, synthetic, status, second_time)""",
)
def j13(t: Tables):
    """First and created times follow the second time here, so equal stamps rank by id."""
    return P.previous_product(t.fx_prod, ["product_id"]).select("product_id", "prev_product_id")


SIDES = ("processing", "segmentation", "classifier", "coastline", "implementation_hash")


def described(t: Tables):
    """Products with grid as a struct and resource hashes as a map."""
    grid = F.struct(F.lit("EPSG:3031").alias("crs"), F.col("grid_height").alias("height"), F.lit(900).alias("width"))
    hashes = F.map_from_arrays(F.array(F.lit("coastline"), F.lit("classifier")), F.array(F.col("mask_hash"), F.coalesce("classifier", F.lit("none"))))
    return t.fx_prod.withColumns({"grid": grid, "resource_hashes": hashes})


def side(prefix: str) -> dict:
    return {c: F.col(prefix + c) for c in (*SIDES, "resource_hashes", "grid")}


@query(
    "j14_comparable",
    """
SELECT a.product_id, a.processing = b.processing AND a.segmentation = b.segmentation AND a.classifier IS NOT DISTINCT FROM b.classifier AND a.coastline = b.coastline
  AND a.mask_hash = b.mask_hash AND a.implementation_hash = b.implementation_hash AND a.grid_height = b.grid_height AS comparable
FROM fx_prod a JOIN fx_prod b ON b.product_id = a.product_id + 6""",
)
def j14(t: Tables):
    columns = [*SIDES, "resource_hashes", "grid"]
    later = described(t).select((F.col("product_id") - 6).alias("product_id"), *[F.col(c).alias(f"next_{c}") for c in columns])
    both = described(t).join(later, "product_id")
    return both.select("product_id", P.comparable(side(""), side("next_")).alias("comparable"))


@query(
    "j15_review_transfer",
    """
WITH m AS (SELECT p_partkey AS model_id, concat('R', CAST(p_partkey % 25 AS VARCHAR)) AS region, p_partkey % 7 = 0 AS synthetic, CASE WHEN p_partkey % 19 = 0 THEN 'other' ELSE 'mean_RGB_uint8' END AS features,
    CASE p_partkey % 4 WHEN 0 THEN 'HV' WHEN 1 THEN NULL ELSE 'HH' END AS polarization, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE concat('texture-', CAST(p_partkey % 2 AS VARCHAR)) END AS contract, p_partkey % 3 = 0 AS review FROM part),
j AS (SELECT m.*, p.product_id, p.region AS pr, p.synthetic AS ps, p.processing AS pc, p.product_id % 2 = 0 AS allowed, p.product_id % 1500 + 1 AS asked FROM fx_prod p LEFT JOIN m ON m.model_id = p.product_id % 1500 + 1),
r AS (SELECT *, concat_ws('; ', CASE WHEN model_id IS NULL THEN 'unknown model' END, CASE WHEN synthetic AND NOT ps THEN 'synthetic model on real scene' END, CASE WHEN features <> 'mean_RGB_uint8' THEN 'unsupported features' END, CASE WHEN polarization <> 'HH' THEN 'polarization differs' END) AS hard,
  concat_ws('; ', CASE WHEN region <> pr THEN 'region differs' END, CASE WHEN contract <> pc THEN 'contract differs' END, CASE WHEN model_id IS NOT NULL AND (review OR contract IS NULL) THEN 'provenance incomplete' END) AS soft FROM j)
SELECT asked AS model_id, product_id, concat_ws('; ', nullif(hard, ''), nullif(soft, '')) AS issues,
  CASE WHEN hard <> '' THEN 'refused' WHEN soft = '' THEN 'accepted' WHEN allowed THEN 'accepted_transfer' ELSE 'needs_permission' END AS review FROM r""",
)
def j15(t: Tables):
    k = F.col("p_partkey")
    models = t.part.select(
        k.alias("model_id"),
        F.concat(F.lit("R"), (k % 25).cast("string")).alias("region"),
        (k % 7 == 0).alias("synthetic"),
        F.when(k % 19 == 0, "other").otherwise("mean_RGB_uint8").alias("features"),
        F.when(k % 4 == 0, "HV").when(k % 4 != 1, "HH").alias("polarization"),
        F.when(k % 5 != 0, F.concat(F.lit("texture-"), (k % 2).cast("string"))).alias("contract"),
        (k % 3 == 0).alias("requires_review"),
    )
    products = t.fx_prod.select(
        "product_id", "region", "synthetic", F.lit("HH").alias("polarization"), F.col("processing").alias("contract"), (F.col("product_id") % 2 == 0).alias("allow_transfer")
    )
    requests = t.fx_prod.select((F.col("product_id") % 1500 + 1).alias("model_id"), "product_id")
    return P.review_transfer(requests, models, products).withColumn("issues", F.array_join("issues", "; "))


_CANDIDATES = "SELECT concat('P', CAST(product_id AS VARCHAR)) AS pair_id, concat(config_hash, CASE WHEN product_id % 11 = 0 THEN '!' ELSE '' END) AS fingerprint FROM fx_prod"
_KNOWN = "SELECT concat('P', CAST(product_id AS VARCHAR)) AS pair_id, config_hash AS fingerprint FROM fx_prod WHERE product_id % 3 <> 0"


def candidates(t: Tables):
    pair = F.concat(F.lit("P"), F.col("product_id").cast("string")).alias("pair_id")
    wanted = t.fx_prod.select(pair, F.concat("config_hash", F.when(F.col("product_id") % 11 == 0, "!").otherwise("")).alias("fingerprint"))
    known = t.fx_prod.filter("product_id % 3 <> 0").select(pair, F.col("config_hash").alias("fingerprint"))
    return wanted, known


@query("j16_new_pairs", f"SELECT * FROM ({_CANDIDATES}) c WHERE c.pair_id NOT IN (SELECT pair_id FROM ({_KNOWN}))")
def j16_new(t: Tables):
    return P.new_pairs(*candidates(t))


@query(
    "j16_conflicting_pairs",
    f"SELECT c.pair_id, c.fingerprint, k.fingerprint AS existing FROM ({_CANDIDATES}) c JOIN ({_KNOWN}) k ON k.pair_id = c.pair_id WHERE k.fingerprint <> c.fingerprint",
)
def j16_conflicts(t: Tables):
    return P.conflicting_pairs(*candidates(t))


@query(
    "t2_incremental_pairs",
    f"""SELECT c.pair_id, CASE WHEN k.pair_id IS NULL THEN 'process' WHEN k.fingerprint = c.fingerprint THEN 'reuse' ELSE 'conflict' END AS action
FROM ({_CANDIDATES}) c LEFT JOIN ({_KNOWN}) k ON k.pair_id = c.pair_id""",
)
def t2(t: Tables):
    return plan_work(*candidates(t)).select("pair_id", "action")


WEEKS = "SELECT CAST(d AS DATE) AS issue_date FROM generate_series(TIMESTAMP '1997-09-01', TIMESTAMP '1998-04-30', INTERVAL 7 DAY) g(d)"


@query(
    "t1_weekly_series",
    f"""
SELECT region, strftime(issue_date, '%Y-%m-%d') AS issue_date, product_id FROM (
  SELECT w.issue_date, p.region, p.product_id, row_number() OVER (PARTITION BY w.issue_date, p.region ORDER BY {_ORDER}) AS k
  FROM ({WEEKS}) w JOIN fx_prod p ON p.second_time <= w.issue_date + INTERVAL 86399 SECOND) WHERE k = 1""",
)
def t1(t: Tables):
    found = P.latest_per_week(t.fx_prod, 1997, columns=["product_id"])
    return found.withColumn("issue_date", day("issue_date"))
