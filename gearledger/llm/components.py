"""Connected components of an edge table, without bringing edges or labels to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gearledger.session import materialise


def components(edges: DataFrame) -> DataFrame:
    """node and the smallest node reachable from it (``component``), for the nodes of the edges (columns a, b).

    Each round takes the smallest label among a node and its neighbours and then the label of that label, so the
    number of rounds grows with the logarithm of the longest chain. Rounds end in written tables. Sums are partial
    before the exchange and joins on a hot node are split by adaptive execution.
    """
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
    links = materialise(both.union(both.select("other", "node")).where("node <> other").distinct(), "links")
    labels = materialise(links.groupBy("node").agg(F.min("other").alias("near")).select(
        "node", F.least("node", "near").alias("component")), "labels")
    while True:
        seen = links.alias("l").join(labels.alias("x"), F.expr("l.other = x.node")).groupBy("l.node").agg(
            F.min("x.component").alias("near"))
        lower = labels.alias("x").join(seen.alias("s"), F.expr("x.node = s.node")).select(
            "x.node", F.col("x.component").alias("old"), F.least("x.component", "s.near").alias("component"))
        jumped = lower.alias("a").join(
            labels.select(F.col("node").alias("at"), F.col("component").alias("next")).alias("b"),
            F.expr("a.component = b.at"), "left").select(
            "node", "old", F.least("a.component", F.coalesce("b.next", "a.component")).alias("component"))
        after = materialise(jumped, "labels")
        if after.where("component <> old").isEmpty():
            return after.select("node", "component")
        labels = after.select("node", "component")
