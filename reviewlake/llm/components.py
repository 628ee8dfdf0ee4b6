"""Connected components by smallest label, with hooking and pointer jumping.

Labels and edges stay in stored tables; the driver only reads whether a round
changed anything. Every round combines before it shuffles, so a hub with very
many edges costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is the smallest node reachable."""
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "cc-edges")
    labels = stored(both.groupBy("a").agg(F.min("b").alias("b"))
                    .select(F.col("a").alias("node"), F.least("a", "b").alias("root")), "cc-labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "root"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("root").alias("seen")))
        low = labels.join(near, "node").select("node", "root", F.least("root", "seen").alias("low"))
        low = stored(low, "cc-low")
        if low.where("low < root").isEmpty():
            return labels
        hooks = low.groupBy("root").agg(F.min("low").alias("hook"))
        jumps = labels.select(F.col("node").alias("low"), F.col("root").alias("jump"))
        labels = stored(low.join(hooks, "root").join(jumps, "low", "left")
                        .select("node", F.least("low", "hook", "jump").alias("root")), "cc-labels")
