"""Connected components by minimum labels and pointer jumping, all in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlelake.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b) -> one row per node: node, label (the smallest node of its component).

    Every round takes the smallest label among neighbours and then the label's own label, so the
    number of rounds grows with the logarithm of the longest path. Each round is written to the shared
    work folder. Hubs are met by aggregates that combine before the shuffle and joins that Spark splits.
    """
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
    both = stored(both.unionAll(edges.select("b", "a")).filter("node <> other").distinct(), "edges")
    labels = stored(both.groupBy("node").agg(F.min("other").alias("low")).select("node", F.least("node", "low").alias("label")), "labels")
    before = None
    while True:
        near = both.join(labels.select(F.col("node").alias("other"), "label"), "other").groupBy("node").agg(F.min("label").alias("low"))
        lower = labels.join(near, "node").select("node", F.least("label", "low").alias("label"))
        # the label of the label: labels are nodes, and a smallest node is its own label
        jumped = lower.join(lower.select(F.col("node").alias("n2"), F.col("label").alias("l2")), F.col("label") == F.col("n2")).select("node", F.least("label", "l2").alias("label"))
        labels = stored(jumped, "labels")
        # labels only fall, so an unchanged sum is an unchanged table
        now = labels.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
        if now == before or now is None:
            return labels
        before = now
