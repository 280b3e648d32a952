"""Connected components of a large graph by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import materialize


def connected_components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """(node, component) for each node that ``edges`` (a, b: long) names; the component is its
    smallest node.

    Each round a node takes the smallest label among its neighbours' and its label's own label, so
    reach doubles as labels settle. Labels are written after each round: a lost executor costs one
    round, and both sides of every join are plain exchanges, which AQE splits at a hub.
    """
    both = materialize(
        edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).where("a <> b"), "graph-edges"
    )
    labels = materialize(
        both.groupBy(F.col("a").alias("node"))
        .agg(F.min("b").alias("low"))
        .select("node", F.least("node", "low").alias("component"), F.lit(True).alias("moved")),
        "graph-labels",
    )
    for _ in range(max_rounds):
        known = labels.select("node", "component")
        near = (
            both.join(known.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("low"))
        )
        above = known.select(F.col("node").alias("component"), F.col("component").alias("up"))
        fresh = F.least("component", "low", "up")
        labels = materialize(
            known.join(near, "node")
            .join(above, "component")
            .select("node", fresh.alias("component"), (fresh < F.col("component")).alias("moved")),
            "graph-labels",
        )
        if labels.where("moved").isEmpty():
            return labels.select("node", "component")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
