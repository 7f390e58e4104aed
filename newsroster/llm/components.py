"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stored


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links`` (``a, b``); label is the smallest node that
    links lead to.

    Each round takes the smallest label among a node and its neighbours and then the label of
    that label, so labels travel over doubling distances. A node with very many links is one row
    on the label side of the joins, and minima are combined before they are shuffled. Each round
    is written to the shared folder; the driver only learns whether a label changed.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "cc-links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.first("a"), F.min("b")).alias("label")), "cc-labels")
    changed = not labels.isEmpty()
    while changed:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(
            F.col("a").alias("node")).agg(F.min("label").alias("near"))
        lower = labels.join(near, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        step = stored(lower.join(jump, "label").select(
            "node", F.least("label", "further").alias("label"),
            (F.least("label", "further") < F.col("old")).alias("changed")), "cc-labels")
        changed = not step.where("changed").isEmpty()
        labels = step.select("node", "label")
    return labels
