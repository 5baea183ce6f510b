"""Connected components of a table of links, as rounds of joins over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import durable


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links(a, b)``; the component is its least node.

    Each round a node takes the least label among its neighbours and itself, and then the
    label of that label, which halves long chains. Labels only fall, so it ends when none does.
    """
    edges = durable(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges"
    )
    labels = durable(edges.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), "labels")
    while True:
        offered = edges.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("_near"))
        lower = labels.join(offered, F.col("node") == F.col("a")).select(
            "node", F.col("label").alias("_old"), F.least("label", "_near").alias("label")
        )
        lower = durable(lower, "lower")
        jump = lower.select(F.col("node").alias("_at"), F.col("label").alias("_jump"))
        after = durable(
            lower.join(jump, F.col("label") == F.col("_at"), "left").select(
                "node", "_old", F.least("label", "_jump").alias("label")
            ),
            "labels",
        )
        if after.where("label < _old").isEmpty():
            return after.select("node", F.col("label").alias("component"))
        labels = after.select("node", "label")
