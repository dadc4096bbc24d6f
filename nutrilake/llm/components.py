"""Connected components of links, as joins."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nutrilake.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable, for every node of links (x, y).

    Each round takes the smallest label among the neighbours (one aggregation,
    so a node with very many links costs one row per task) and then the label
    of that label, which halves the remaining distances.  Rounds are written
    to shared storage; only a count reaches the driver.
    """
    both = written(links.select("x", "y").unionByName(links.select(F.col("y").alias("x"), F.col("x").alias("y"))),
                   "links")
    labels = written(both.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("_m"))
                     .select("node", F.least("node", "_m").alias("label")), "labels")
    while True:
        near = (both.join(labels, both["y"] == labels["node"]).groupBy("x").agg(F.min("label").alias("near")))
        stepped = labels.join(near, labels["node"] == near["x"]).select(
            "node", "label", F.least("label", "near").alias("step"))
        above = labels.select(F.col("node").alias("step"), F.col("label").alias("up"))
        after = written(stepped.join(above, "step", "left").select(
            "node", F.col("label").alias("old"), F.least("step", F.coalesce("up", "step")).alias("label")), "labels")
        labels = after.select("node", "label")
        if after.where(F.col("old") != F.col("label")).limit(1).count() == 0:
            return labels
