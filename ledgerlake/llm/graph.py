"""Connected components over a table of links, never leaving Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import keep


def components(links: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``links`` (a, b): comp is the smallest
    node reachable.  In each round a node hooks to its smallest neighbour, if
    that is smaller, chains of hooks are followed to their ends by doubling,
    and links are drawn between the ends, where most become loops and go.  A
    node that stays two rounds has taken in another, so rounds are few, and
    the links of all rounds are a small multiple of those given."""
    low, high = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    edges = keep(links.where("a <> b").select(low, high).distinct(), "edges")
    labels = keep(edges.select(F.col("a").alias("node")).unionAll(edges.select("b")).distinct().withColumn("comp", F.col("node")), "labels")
    while not edges.isEmpty():
        hooks = keep(edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("top")), "hooks")
        while True:
            further = hooks.select(F.col("node").alias("top"), F.col("top").alias("far"))
            longer = keep(hooks.join(further, "top", "left").select("node", F.coalesce("far", "top").alias("top"), F.col("far").isNotNull().alias("moved")), "hooks")
            hooks = longer.select("node", "top")
            if longer.where("moved").isEmpty():
                break

        def at_end(df: DataFrame, name: str) -> DataFrame:
            ends = hooks.select(F.col("node").alias(name), F.col("top").alias("_top"))
            return df.join(ends, name, "left").withColumn(name, F.coalesce("_top", name)).drop("_top")

        labels = keep(at_end(labels, "comp"), "labels")
        edges = keep(at_end(at_end(edges, "a"), "b").where("a <> b").select(low, high).distinct(), "edges")
    return labels.select("node", "comp")
