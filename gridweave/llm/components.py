"""Connected components by joins: labels shrink to the smallest reachable id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridweave.llm.spark_util import cut, partitions


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (the smallest id reachable) for every node of ``edges``.

    Every round a node takes the smallest among its label, its neighbours' labels, and the label of the node that its own label
    names, so that chains shrink by halves; rounds are cut by a checkpoint. All these labels are looked up in one join, so
    nothing is collected but whether one changed. Nodes ask by (id, salt), so that the hub of a star, or the one label of a
    large component, is many keys. Components that are known already come in as edges from their nodes to their ids."""
    salt = F.pmod(F.xxhash64("node"), F.lit(partitions(edges.sparkSession))).cast("int").alias("salt")
    both = edges.select(F.col(a).alias("node"), F.col(b).alias("other")).unionByName(edges.select(F.col(b).alias("node"), F.col(a).alias("other"))).where("node <> other").distinct()
    both = cut(both)
    labels = cut(both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("component")))
    while True:
        asked = both.unionByName(labels.select("node", F.col("component").alias("other"))).select("node", "other", salt)
        known = asked.select("other", "salt").distinct().join(labels.select(F.col("node").alias("other"), "component"), "other")
        told = asked.join(known, ["other", "salt"]).select("node", "component", F.lit(None).cast("bigint").alias("before"))
        every = told.unionByName(labels.select("node", "component", F.col("component").alias("before")))
        moved = cut(every.groupBy("node").agg(F.min("component").alias("component"), F.min("before").alias("before")))
        changed = moved.where("component <> before").limit(1).count()
        labels = moved.select("node", "component")
        if not changed:
            return labels
