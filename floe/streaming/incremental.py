"""Which candidate pairs still need processing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def plan_work(candidates: DataFrame, products: DataFrame) -> DataFrame:
    """``process``, ``reuse`` or ``conflict`` for every candidate ``pair_id, fingerprint``.

    A product without fingerprint, or with others only, is a conflict; any equal one is reused.
    """
    known = products.groupBy("pair_id").agg(F.max("fingerprint").alias("existing"), F.lit(True).alias("_any"))
    equal = products.filter("fingerprint is not null").select("pair_id", "fingerprint").distinct().withColumn("_equal", F.lit(True))
    joined = candidates.join(known, "pair_id", "left").join(equal, ["pair_id", "fingerprint"], "left")
    action = F.when(F.col("_equal"), "reuse").when(F.col("_any"), "conflict").otherwise("process")
    return joined.withColumn("action", action).select(*candidates.columns, "existing", "action")
