"""Connected components of a table of links, by least labels and jumps to the label's label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowplan.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, label) for the ends of ``links`` (a, b); the label is the least node of the component.

    Every round each node takes the least label of itself and its neighbours and then that label's
    own label; each round is a written table. Stars settle in two or three rounds, chains in a number
    that grows with the logarithm of their length.
    """
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other"))
    both = written(both.union(both.select(F.col("other").alias("node"), F.col("node").alias("other"))).distinct(), "links")
    labels = written(both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("other"), F.col("label").alias("near")), "other")
        least = near.groupBy("node").agg(F.min("near").alias("near"))
        step = labels.join(least, "node").select("node", "label", F.least("label", "near").alias("next"))
        jump = step.select(F.col("node").alias("next"), F.col("next").alias("far"))
        moved = step.join(jump, "next").select("node", "label", F.least("next", "far").alias("next"))
        moved = written(moved, "labels")
        changed = moved.where("next < label").limit(1).count()
        labels = moved.select("node", F.col("next").alias("label"))
        if not changed:
            return labels
