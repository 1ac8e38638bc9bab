"""Connected components of an edge table, by smallest labels with pointer jumping; each round is a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import stage


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """node and root (the smallest node of its component) of every node of an edge. Nulls are no nodes."""
    pairs = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x <> y")
    both = stage(pairs.unionByName(pairs.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "edges")
    label = stage(both.groupBy("x").agg(F.min("y").alias("m")).select(F.col("x").alias("node"), F.least("x", "m").alias("root")), "labels")
    while True:
        # The smallest label around a node, and around the node that its label names.
        around = both.join(label, both.y == label.node).groupBy("x").agg(F.min("root").alias("m"))
        near = label.join(around, label.node == around.x).select("node", F.col("root").alias("old"), F.least("root", "m").alias("root"))
        named = near.groupBy(F.col("old").alias("at")).agg(F.min("root").alias("m"))
        far = near.join(named, near.root == named["at"], "left").select("node", "old", F.least("root", F.coalesce("m", "root")).alias("root"))
        jump = label.select(F.col("node").alias("via"), F.col("root").alias("to"))
        jumped = far.join(jump, far.root == jump.via, "left").select("node", "old", F.least("root", F.coalesce("to", "root")).alias("root"))
        new = stage(jumped, "labels")
        if new.where("old <> root").isEmpty():
            return new.select("node", "root")
        label = new.select("node", "root")
