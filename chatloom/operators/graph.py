"""Components and reachability of links between rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.artifacts import saved


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, component): the least node that each node reaches over undirected ``edges`` (a, b).

    Labels spread along edges, and from a label to that label's own label, so long
    chains shorten by half a round. Only a count a round reaches the driver. Labels
    only fall, so the rounds end by themselves and have no bound.
    """
    both = saved(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct())
    labels = saved(nodes.select("node", F.col("node").alias("component")).distinct())
    while True:
        far = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("component").alias("near"))
        step = labels.join(far, labels["node"] == far["a"], "left").select("node", "component", F.least("component", F.coalesce("near", "component")).alias("new"))
        up = step.select(F.col("node").alias("up"), F.col("new").alias("up_new"))
        step = saved(
            step.join(up, step["new"] == up["up"], "left").select("node", F.col("component").alias("old"), F.coalesce("up_new", "new").alias("component"))
        )
        changed = step.where("old <> component").limit(1).count()
        labels = step.select("node", "component")
        if not changed:
            break
    return labels


def closure(seeds: DataFrame, edges: DataFrame) -> DataFrame:
    """(seed, node): all nodes that each seed reaches over undirected ``edges``.

    What a seed reaches is its component, so the rounds are those of ``components``
    and do not grow with the length of a chain.
    """
    own = seeds.select("node").distinct()
    nodes = own.unionByName(edges.select(F.col("a").alias("node"))).unionByName(edges.select(F.col("b").alias("node")))
    labels = components(nodes, edges)
    starts = labels.join(own, "node", "left_semi").select(F.col("node").alias("seed"), "component")
    return starts.join(labels, "component").select("seed", "node")
