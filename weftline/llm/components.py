"""Connected components of large graphs, without a driver-side or one-task step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.session import settle


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node of an edge; the label is the smallest node it can reach.

    Each round takes the smallest label among neighbours, then the label of that label, which
    halves the distances. Hub nodes only take part in minima, which Spark combines before the
    shuffle. Each round is written to the shared folder. Null ends are left out; self-loops are allowed.
    """
    pairs = edges.select(F.col(a).alias("node"), F.col(b).alias("other")).filter(
        F.col("node").isNotNull() & F.col("other").isNotNull()
    )
    both = settle(
        pairs.unionByName(pairs.select(F.col("other").alias("node"), F.col("node").alias("other"))).distinct(), "edges"
    )
    labels = settle(
        both.groupBy("node").agg(F.least("node", F.min("other")).alias("label")), "labels"
    )
    while True:
        others = labels.select(F.col("node").alias("other"), F.col("label").alias("found"))
        near = both.join(others, "other").groupBy("node").agg(F.min("found").alias("found"))
        lower = labels.join(near, "node").select(
            "node", F.col("label").alias("before"), F.least("label", "found").alias("middle")
        )
        ends = labels.select(F.col("node").alias("middle"), F.col("label").alias("end"))
        step = lower.join(ends, "middle", "left").select(
            "node", "before", F.least("middle", F.coalesce("end", "middle")).alias("label")
        )
        step = settle(step, "labels")
        labels = step.select("node", "label")
        if step.filter(F.col("before") != F.col("label")).isEmpty():
            return labels
