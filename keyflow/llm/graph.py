"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyflow.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node of its component, for every node of the links (``a``, ``b``).

    Each round takes the smallest label among the neighbours and then the label of that label, so the
    number of rounds grows with the logarithm of the longest chain. Every round is written out; links
    and labels never reach the driver.
    """
    both = written(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        lower = labels.join(near, labels["node"] == near["a"]).select("node", F.least("label", "near").alias("label"))
        lower = written(lower, "labels")
        target = lower.select(F.col("node").alias("_at"), F.col("label").alias("_to"))
        jumped = lower.join(target, lower["label"] == target["_at"]).select("node", F.col("_to").alias("label"))
        jumped = written(jumped, "labels")
        before = labels.select(F.col("node").alias("_at"), F.col("label").alias("_was"))
        changed = jumped.join(before, jumped["node"] == before["_at"]).where(F.col("label") != F.col("_was"))
        labels = jumped
        if changed.isEmpty():
            return labels
