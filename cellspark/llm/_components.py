"""Connected components of a link table, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``links`` (a, b): comp is the smallest node
    that is reachable.  Each round takes the smallest label among the neighbours
    and then the label's own label, so a chain of n links takes about log n
    rounds; it runs until no label changes.  Every round is a written table."""
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(
        links.select(F.col("b").alias("node"), F.col("a").alias("other")))
    edges = materialize(both.where("node <> other").distinct())
    labels = materialize(edges.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("comp")))
    while True:
        near = (edges.join(labels.select(F.col("node").alias("other"), F.col("comp").alias("near")), "other")
                .groupBy("node").agg(F.min("near").alias("near")))
        step = labels.join(near, "node").select("node", "comp", F.least("comp", "near").alias("low"))
        # a label is itself a node: jump to the label it had
        jump = labels.select(F.col("node").alias("low"), F.col("comp").alias("far"))
        new = materialize(step.join(jump, "low").select(
            "node", F.least("low", "far").alias("comp"), (F.least("low", "far") != F.col("comp")).alias("moved")))
        moved = not new.where("moved").isEmpty()
        labels = new.select("node", "comp")
        if not moved:
            return labels
