"""Connected components of a link table, as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) of each node in ``links`` (a, b); the component is its least node.

    Each round a node takes the least label among its neighbours' and its own,
    then its label's label (pointer jumping), so a path of n links settles in
    about log n rounds. Nothing but a change flag reaches the driver.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct()
                  .toDF("node", "other"), "links")
    labels = stored(both.groupBy("node").agg(F.min("other").alias("o"))
                    .select("node", F.least("node", "o").alias("component")), "labels")
    while True:
        near = (both.join(labels.toDF("other", "theirs"), "other")
                .groupBy("node").agg(F.min("theirs").alias("theirs")))
        jump = labels.toDF("label", "further")
        after = (labels.join(near, "node")
                 .withColumn("label", F.least("component", "theirs"))
                 .join(jump, "label", "left")
                 .select("node", F.least("label", F.coalesce("further", "label"))
                         .alias("component"), F.col("component").alias("before")))
        after = stored(after, "labels")
        changed = after.filter("component <> before").limit(1).count()
        labels = after.drop("before")
        if not changed:
            return labels
