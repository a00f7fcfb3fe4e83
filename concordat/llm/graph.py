"""Connected components of a link table, as joins and grouped minima over stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the smallest node of the same type that is reachable, for every node of a link.

    Each round gives a node, and the root it had, the smallest label next to it, then follows labels one step
    further, so that chains halve. Both joins read two stored tables: a node with very many links is a skewed join
    partition that adaptive execution can split, and minima combine before their shuffle. Only a count of changed
    labels reaches the driver. Links with a null end or to themselves add nothing but their node.
    """
    links = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null")
    both = stored(links.union(links.select("b", "a")).distinct())
    labels = stored(both.select(F.col("a").alias("node")).distinct().withColumn("label", F.col("node")))
    while True:
        near = both.join(labels, both.a == labels.node).groupBy(F.col("b").alias("node")).agg(F.min("label").alias("low"))
        near = stored(near)
        held = stored(labels.join(near, "node").select("node", "label", F.least("label", "low").alias("low")))
        proposed = held.select("node", "low").union(held.select("label", "low"))
        lower = stored(proposed.groupBy("node").agg(F.min("low").alias("low")))
        ahead = lower.select(F.col("node").alias("low"), F.col("low").alias("root"))
        found = stored(
            lower.join(ahead, "low").join(labels, "node").select("node", F.col("label").alias("old"), F.col("root").alias("label"))
        )
        changed = found.where("old <> label").limit(1).count()
        discard(labels, near, held, lower)
        labels = found
        if not changed:
            discard(both)
            return labels.select("node", F.col("label").alias("root"))
