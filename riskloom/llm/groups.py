"""Connected groups of linked ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskloom.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """`node`, `label`: the smallest id of each node's group. `links`: a, b (not null).

    Each round a node takes the smallest label among its own and its neighbours', then the label of
    that label, which halves the distance that is left. Labels are written each round; a hub's
    links are combined map-side.
    """
    both = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        taken = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        taken = stored(taken, "labels_taken")
        jump = taken.select(F.col("node").alias("label"), F.col("label").alias("next"))
        labels = stored(taken.join(jump, "label").select("node", "old", F.col("next").alias("label")), "labels")
        if labels.where("old != label").isEmpty():
            return labels.select("node", "label")
