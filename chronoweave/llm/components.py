"""Connected components of a link table, by least labels and pointer jumping on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoweave.session import materialized


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b): the least node that can be reached.

    Each round a node takes the least label among itself and its neighbours, then the label of its
    label, so the rounds grow with the logarithm of a component's diameter, not its size.  Labels
    are written after each round; only the number of changed labels comes to the driver.
    """
    both = links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct()
    edges = materialized(both, "links")
    labels = materialized(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("component")), "labels")
    while True:
        heard = edges.join(labels, edges["b"] == labels["node"]).groupBy(F.col("a").alias("node")).agg(F.min("component").alias("heard"))
        step = labels.join(heard, "node").select("node", F.col("component").alias("old"), F.least("component", "heard").alias("component"))
        jump = labels.select(F.col("node").alias("to"), F.col("component").alias("further"))
        step = step.join(jump, step["component"] == jump["to"], "left").select(
            "node", "old", F.least("component", F.coalesce("further", "component")).alias("component"))
        step = materialized(step, "labels")
        if step.where("component <> old").limit(1).count() == 0:
            return step.select("node", "component")
        labels = step.select("node", "component")
