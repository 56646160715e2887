"""Connected components of a link table, by joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import forget, settled


def components(links: DataFrame) -> DataFrame:
    """(node, label) for the ends of rows (a, b); label is the smallest node reachable.

    Each round takes the smallest label among neighbours and then the label's own
    label, so rounds follow the logarithm of the longest path.  A node with many
    links is combined on the map side and its join can be split.
    """
    both = settled(
        links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a")).distinct(), "links"
    )
    labels = settled(both.groupBy(F.col("u").alias("node")).agg(F.least(F.col("node"), F.min("v")).alias("label")), "labels")
    last = labels
    while True:
        near = (
            both.join(labels, F.col("v") == F.col("node"))
            .select(F.col("u").alias("node"), "label")
            .union(labels)
            .groupBy("node")
            .agg(F.min("label").alias("label"))
        )
        jump = labels.select(F.col("node").alias("_node"), F.col("label").alias("_jump"))
        old = labels.select(F.col("node").alias("_old_node"), F.col("label").alias("_old"))
        after = settled(
            near.join(jump, F.col("label") == F.col("_node"), "left")
            .select("node", F.least("label", "_jump").alias("label"))
            .join(old, F.col("node") == F.col("_old_node"))
            .select("node", "label", (F.col("label") != F.col("_old")).alias("changed")),
            "labels",
        )
        done = after.filter("changed").isEmpty()
        forget(last)
        last, labels = after, after.select("node", "label")
        if done:
            forget(both)
            return labels
