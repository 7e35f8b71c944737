"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.llm.texts import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, comp) for each end of `links` (a, b): the smallest node that its links reach.

    Each round a node takes the smallest label of its neighbours, then the label of that label, so the rounds
    grow with the logarithm of the longest path. A round is written to the shared folder, which
    cuts the lineage; the loop ends with the first round that changes nothing. Labels are minima, summed up
    before they are shuffled; the links of a node with very many meet its label in one task, unless Spark splits it.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = materialize(both.filter("a <> b").distinct(), "edges")
    labels = materialize(edges.groupBy(F.col("a").alias("node")).agg(
        F.least(F.first("a"), F.min("b")).alias("comp")), "labels")
    while True:
        near = (edges.join(labels, edges.b == labels.node).groupBy("a").agg(F.min("comp").alias("near")))
        step = labels.join(near, labels.node == near.a).select(
            "node", "comp", F.least("comp", "near").alias("best"))
        step = materialize(step, "step")
        ahead = step.select(F.col("node").alias("at"), F.col("best").alias("further"))
        jumped = step.join(ahead, step.best == ahead.at, "left").select(
            "node", F.least("best", "further").alias("comp"), "comp")
        jumped = jumped.toDF("node", "comp", "old")
        jumped = materialize(jumped, "labels")
        labels = jumped.select("node", "comp")
        if jumped.filter("comp <> old").isEmpty():
            return labels
