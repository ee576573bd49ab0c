"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import cut


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b: long); the root is the smallest
    node that can be reached. No links give no rows.

    Each round a node takes the smallest root among its neighbours' and then its root's
    root, so a chain of n links takes about log n rounds. Every table that is joined has
    been written before: a node with very many links is split by adaptive execution.
    """
    both = cut(
        links.select("a", "b").union(links.select("b", "a")).where("a <> b").toDF("a", "b").distinct(), "links"
    )
    labels = cut(both.groupBy("a").agg(F.min("b").alias("b")).select(
        F.col("a").alias("node"), F.least("a", "b").alias("root")), "labels")
    while True:
        offers = (
            both.join(labels, both["b"] == labels["node"]).select("a", "root")
            .groupBy("a").agg(F.min("root").alias("offer"))
        )
        lower = cut(
            labels.join(offers, labels["node"] == offers["a"])
            .select("node", F.least("root", "offer").alias("root"), (F.col("offer") < F.col("root")).alias("moved")),
            "labels",
        )
        if lower.where("moved").isEmpty():
            return lower.select("node", "root")
        roots = lower.select(F.col("node").alias("at"), F.col("root").alias("next"))
        labels = cut(lower.join(roots, lower["root"] == roots["at"]).select("node", F.col("next").alias("root")), "labels")
