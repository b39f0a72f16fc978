"""Connected components of an edge table, as iterated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchloom.llm.session import cut_lineage

MAX_ROUNDS = 60
#: Labels are written in parts of so many rows, so that few of them are not as many files as there are partitions.
PART_ROWS = 25_000


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for the nodes of ``edges (a, b)``; the component is its least node.

    Each round gives every node the least label among its neighbours and then
    that label's own label, so a chain is walked in steps that double; it ends
    when no label has changed.  Labels and edges stay in Spark.  No edges give
    an empty table.
    """
    both = cut_lineage(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).filter("a <> b").distinct())
    parts = 1 + both.count() // PART_ROWS
    labels = cut_lineage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")).coalesce(parts))
    for _ in range(MAX_ROUNDS):
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        step = labels.join(near, "node").select("node", "component", F.least("component", "near").alias("next"))
        hop = labels.select(F.col("node").alias("next"), F.col("component").alias("hop"))
        step = cut_lineage(step.join(hop, "next", "left").select("node", F.col("component").alias("before"), F.least("next", F.coalesce("hop", "next")).alias("component")).coalesce(parts))
        changed = step.filter("before <> component").limit(1).count()
        labels = step.select("node", "component")
        if not changed:
            return labels
    raise RuntimeError("components did not settle")
