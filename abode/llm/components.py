"""Connected components of a large edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abode.plans.materialize import materialize


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges`` (columns ``a`` and ``b``): the least node it is connected to.

    Each round takes the least label among neighbours, then the label of the
    label, and ends when no label changes. Every join reads stored tables on
    both sides, so a node with very many edges, or a label that most nodes
    carry, is split by adaptive execution.
    """
    both = materialize(
        edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    )
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")))
    total = _total(labels)
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").select(F.col("a").alias("node"), "label")
        hop = materialize(labels.unionByName(near).groupBy("node").agg(F.min("label").alias("label")))
        above = hop.select(F.col("node").alias("label"), F.col("label").alias("up"))
        labels = materialize(hop.join(above, "label").select("node", F.col("up").alias("label")))
        now = _total(labels)
        if now == total:
            return labels
        total = now


def _total(labels: DataFrame):
    """Labels only fall, so their sum stays the same exactly if all of them do."""
    return labels.agg(F.sum(F.col("label").cast("decimal(38,0)"))).collect()[0][0]
