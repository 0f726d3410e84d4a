"""Connected components by label propagation with pointer jumping, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import join_hot, stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) of the graph links (a, b); component is the least node reached.

    Each round hooks every component onto the least component next to it and then follows pointers twice, so
    rounds grow with the logarithm of the longest chain. Each round is written: its lineage stays short. A hot node is only
    ever a group of partial minima, and the label of a component that holds very many nodes goes to them by broadcast.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b")
    label = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("component")), "component")
    edges = both.where("a < b")
    while True:
        of_a = label.select(F.col("node").alias("a"), F.col("component").alias("ca"))
        of_b = label.select(F.col("node").alias("b"), F.col("component").alias("cb"))
        crossing = stored(edges.join(of_a, "a").join(of_b, "b").where("ca <> cb").select("ca", "cb").distinct(), "crossing")
        if crossing.isEmpty():
            jumped = _jump(label)
            if jumped.join(label, ["node", "component"], "left_anti").isEmpty():
                return label
            label = jumped
            continue
        hook = crossing.select(F.greatest("ca", "cb").alias("node"), F.least("ca", "cb").alias("m")).groupBy("node").agg(F.min("m").alias("m"))
        # a component's own label moves to the least label next to it; members follow by pointers
        moved = join_hot(label, stored(hook.withColumnRenamed("node", "component"), "hook"), "component").select("node", F.least("component", F.coalesce("m", "component")).alias("component"))
        label = _jump(_jump(stored(moved, "moved")))


def _jump(label: DataFrame) -> DataFrame:
    to = label.select(F.col("node").alias("component"), F.col("component").alias("next"))
    return stored(join_hot(label, to, "component").select("node", F.least("component", F.coalesce("next", "component")).alias("component")), "jump")
