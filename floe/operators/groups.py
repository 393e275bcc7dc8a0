"""Acquisition groups: scenes of one region that share a date, directly or through others."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floe.session import durable

MAX_ROUNDS = 60


def scene_dates(scenes: DataFrame) -> DataFrame:
    """One row per scene and acquisition date."""
    return scenes.select("scene_id", "region", F.explode(F.array_distinct("dates")).alias("date"))


def shared_acquisitions(scenes: DataFrame) -> DataFrame:
    """Dates used by more than one scene of a region, with how many scenes and the first of them.

    This is the star form of "these scenes intersect": each scene links to the first
    one of its date, never every scene to every other.
    """
    return (
        scene_dates(scenes)
        .groupBy("region", "date")
        .agg(F.min("scene_id").alias("first_scene"), F.count("*").alias("scenes"))
        .filter("scenes > 1")
    )


def acquisition_groups(scenes: DataFrame) -> DataFrame:
    """Connected components; the group is its smallest scene id.

    Scenes with the same region and dates collapse into one node first. Nodes and
    dates then form a bipartite graph; each round takes the smallest label over a
    date, hooks whole trees onto it and halves every path, so the number of rounds
    grows with the logarithm of the longest chain. Every step is a partial aggregate
    or an equi-join, and each round is checkpointed.
    """
    keyed = scenes.withColumn("dates", F.array_sort(F.array_distinct("dates")))
    nodes = keyed.groupBy("region", "dates").agg(F.min("scene_id").alias("node"))
    links = durable(nodes.select("node", F.explode("dates").alias("date"), "region"))
    labels = durable(nodes.select("node", F.col("node").alias("parent")))
    for _ in range(MAX_ROUNDS):
        known = links.join(labels, "node")
        by_date = known.groupBy("region", "date").agg(F.min("parent").alias("low"))
        # smallest parent each node can see through its dates
        seen = known.join(by_date, ["region", "date"]).groupBy("node", "parent").agg(F.min("low").alias("low"))
        # a tree hooks onto the smallest label any of its nodes sees
        roots = seen.groupBy(F.col("parent").alias("root")).agg(F.min("low").alias("hook"))
        hooked = seen.join(roots, F.col("parent") == F.col("root"), "left").select(
            "node", F.col("parent").alias("was"), F.least("low", "hook").alias("parent")
        )
        # path halving: follow the new parent one step further
        step = hooked.select(F.col("node").alias("root"), F.col("parent").alias("next"))
        moved = hooked.join(step, F.col("parent") == F.col("root"), "left").select(
            "node", "was", F.least("parent", F.coalesce("next", "parent")).alias("parent")
        )
        moved = durable(moved)
        labels = moved.select("node", "parent")
        if moved.filter("parent <> was").isEmpty():
            break
    else:
        raise RuntimeError("acquisition groups did not settle")
    grouped = nodes.join(labels, "node").select("region", "dates", F.col("parent").alias("group"))
    return keyed.join(grouped, ["region", "dates"]).select("scene_id", "region", "group")
