"""Connected components of an edge table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.staging import staged


def connected(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every node that has an edge; ``edges``: ``a``, ``b`` long.

    Each round gives every node the smallest label around it, then that label's own label, so
    that paths shrink to a fraction per round; it ends when nothing changes. A label's rows are summed per task before they move, and
    each round is a written table. Only the number of changes reaches the driver.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = staged(both.filter("a <> b").distinct(), "edges")
    labels = staged(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("component")), "labels")
    while True:
        around = (
            both.join(labels, both["b"] == labels["node"])
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        lower = labels.join(around, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("label"))
        label_of = labels.select(F.col("node").alias("label"), F.col("component").alias("further"))
        new = lower.join(label_of, "label", "left").select(
            "node", F.least("label", F.coalesce("further", "label")).alias("component"), (F.col("old") != F.least("label", F.coalesce("further", "label"))).alias("changed")
        )
        new = staged(new, "labels")
        changed = new.filter("changed").limit(1).count()
        labels = new.select("node", "component")
        if not changed:
            return labels
