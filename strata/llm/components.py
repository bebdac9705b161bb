"""Connected components of a graph of links, by smallest reachable id.

Every node takes the smallest label among itself and its neighbours, then the
label of that label (pointer jumping), until nothing changes; the number of
rounds grows with the logarithm of a component's diameter in practice.  Links
and labels stay in tables; each round is written to the shared folder, so a lost
executor repeats one round only.  A node with a third of all links is one row of
labels and many of links, which Spark's skew join splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import discard, written


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node in ``links`` (a, b: long)."""
    both = written(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                   .where("a != b").distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
                     .select("node", F.least("node", "b").alias("component")), "labels")
    while True:
        near = (both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("component").alias("near")))
        step = (labels.select("node", F.col("component").alias("old")).join(near, F.col("node") == F.col("a"))
                .select("node", "old", F.least("old", "near").alias("new")))
        # Pointer jumping: the label of the label in the round before.
        jump = labels.select(F.col("node").alias("_at"), F.col("component").alias("_to"))
        after = written(step.join(jump, F.col("new") == F.col("_at"), "left")
                        .select("node", "old", F.least("new", F.coalesce("_to", "new")).alias("component")), "labels")
        changed = after.where("old != component").limit(1).count()
        discard(labels)
        labels = after
        if not changed:
            discard(both)
            return labels.select("node", "component")
