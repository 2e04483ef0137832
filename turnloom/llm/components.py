"""Connected components of a graph given as a DataFrame of links, by passing on the smallest label and halving paths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import with_checkpoints


def connected_components(links: DataFrame) -> DataFrame:
    """node and component (its smallest node) for every node of ``links`` (a, b: long). An empty graph gives no rows.

    Each round a node takes the smallest label among its own and its neighbours', then its label's label. Nothing but
    the number of changed labels comes to the driver, and each round's labels are checkpointed.
    """
    with_checkpoints(links.sparkSession)
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a != b").distinct().checkpoint()
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("component")).checkpoint()
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("component").alias("low"))
        passed = labels.join(near, labels.node == near.a).select("node", F.col("component").alias("old"), F.least("component", "low").alias("component"))
        up = labels.select(F.col("node").alias("component"), F.col("component").alias("above"))
        new = passed.join(up, "component", "left").select("node", "old", F.least("component", F.coalesce("above", "component")).alias("component")).checkpoint()
        changed = new.where("old != component").limit(1).count()
        labels = new.select("node", "component")
        if not changed:
            return labels
