"""Connected components of a link table, by smallest labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecloom.llm.staging import staged


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable over ``links`` (a, b), for every node that has a link.

    Each round takes the smallest label next door and then the label of that label, so that chains shrink by powers of
    two. Rounds are written to the shared folder; only the number of changes reaches the driver.
    """
    both = links.select(F.col("a").alias("src"), F.col("b").alias("dst"))
    both = staged(both.union(links.select(F.col("b"), F.col("a"))).distinct(), "links")
    labels = staged(both.groupBy("src").agg(F.min("dst").alias("m")).select(F.col("src").alias("node"), F.least("src", "m").alias("label")), "labels")
    while True:
        near = both.join(labels, both.dst == labels.node).groupBy("src").agg(F.min("label").alias("m"))
        lower = labels.join(near, F.col("node") == F.col("src"), "left")
        lower = staged(lower.select("node", F.col("label").alias("old"), F.least("label", "m").alias("label")), "labels")
        roots = lower.select(F.col("node").alias("root"), F.col("label").alias("root_label"))
        jumped = lower.join(roots, F.col("label") == F.col("root"), "left")
        following = staged(jumped.select("node", "old", F.least("label", F.coalesce("root_label", "label")).alias("label")), "labels")
        labels = following.select("node", "label")
        if following.where("label < old").isEmpty():
            return labels
