"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesales.llm.common import cut


def components(links: DataFrame) -> DataFrame:
    """(node, comp) of every node in links(a, b); comp: the smallest node that links lead to.

    Each round a node takes the smallest label around it, then the label of its label, so long chains halve.
    Labels are written to the shared folder every round; only a count comes to the driver.
    """
    links = links.select("a", "b").filter("a <> b")
    around = cut(links.union(links.select("b", "a")).distinct(), "links")
    labels = cut(around.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("comp")), "labels")
    while True:
        near = around.join(labels.select(F.col("node").alias("b"), F.col("comp").alias("seen")), "b") \
            .groupBy(F.col("a").alias("node")).agg(F.min("seen").alias("seen"))
        lower = labels.join(near, "node").select("node", "comp", F.least("comp", "seen").alias("low"))
        further = labels.select(F.col("node").alias("low"), F.col("comp").alias("jump"))
        after = cut(lower.join(further, "low").select(
            "node", F.col("jump").alias("comp"), (F.col("jump") != F.col("comp")).alias("moved")), "labels")
        if not after.filter("moved").head(1):
            return after.select("node", "comp")
        labels = after.select("node", "comp")
