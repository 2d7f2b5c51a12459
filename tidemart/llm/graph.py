"""Connected components by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node that can be reached, for every node of `edges` (a, b; long).

    Each round a node takes the smallest label around it and then its label's label, so paths
    shorten by half.  Sums stay one row per node; nothing of the graph reaches the driver but the
    number of labels that changed.  No edges give no rows.
    """
    both = written(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                   .filter("a <> b").distinct(), "edges")
    labels = written(both.groupBy("a").agg(F.min("b").alias("low"))
                     .select(F.col("a").alias("node"), F.least("a", "low").alias("root")), "labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "root"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("root").alias("low")))
        lower = labels.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "low").alias("root"))
        jump = lower.select(F.col("node").alias("root"), F.col("root").alias("far"))
        step = written(lower.join(jump, "root", "left").select(
            "node", "old", F.least("root", F.coalesce("far", "root")).alias("root")), "labels")
        labels = step.select("node", "root")
        if not step.filter("old <> root").limit(1).count():
            return labels
