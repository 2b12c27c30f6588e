"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revloom.llm.shared import keep


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b): the smallest node it can reach.

    Each round, every node takes the smallest label among its neighbours and then its
    label's label, so long chains shorten quickly.  Rounds are stored in the shared
    folder; nothing but a count of changes reaches the driver.  Nodes in no link are absent.
    """
    both = links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).where("a <> b").distinct()
    both = keep(both, "links")
    labels = keep(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        found = labels.join(near.withColumnRenamed("a", "node"), "node").select(
            "node", F.col("label").alias("was"), F.least("label", "near").alias("label")
        )
        jump = found.select(F.col("node").alias("label"), F.col("label").alias("further"))
        found = keep(
            found.join(jump, "label", "left").select("node", "was", F.coalesce("further", "label").alias("label")), "labels"
        )
        changed = found.where("label <> was").limit(1).count()
        labels = found.select("node", "label")
        if not changed:
            return labels
