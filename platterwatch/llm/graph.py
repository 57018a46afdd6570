"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platterwatch.sources.storage import stage


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (a, b): root is the smallest node reachable.

    Each round takes the smallest label among the neighbours and then the label of that label, so
    the number of rounds grows with the logarithm of a chain's length. Labels only decrease, so
    an unchanged sum means that all are final. Every round is a staged table; only sums reach the driver.
    A hub's rows are aggregated before they move, and Spark splits the hub's side of a join.
    """
    both = stage(
        links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .where("a is not null and b is not null").distinct(),
        "links",
    )
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("root")), "roots")
    total = None
    while True:
        now = labels.agg(F.sum(F.col("root").cast("decimal(38,0)")).alias("s")).first()["s"]
        if now == total:
            return labels
        total = now
        near = (
            both.join(labels, both["b"] == labels["node"])
            .groupBy("a")
            .agg(F.min("root").alias("near"))
        )
        lower = labels.join(near, labels["node"] == near["a"], "left").select(
            "node", F.least("root", "near").alias("root")
        )
        up = labels.select(F.col("node").alias("up"), F.col("root").alias("up_root"))
        labels = stage(
            lower.join(up, lower["root"] == up["up"], "left").select(
                "node", F.least("root", "up_root").alias("root")
            ),
            "roots",
        )
