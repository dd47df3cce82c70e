"""Connected components by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root): root is the smallest node reachable over ``links`` (a, b).

    Minimum labels travel along links, and every round also replaces a label by
    its own label (pointer jumping), so long chains shorten fast. Each round is
    checkpointed; only the number of changed labels reaches the driver. A node
    with very many links is a skewed join key that AQE splits; its labels are
    combined by a partial aggregate. No links: no rows."""
    both = cut(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
               .filter("a <> b").distinct())
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
                 .select("node", F.least("node", "low").alias("root")))
    for _ in range(rounds):
        near = (both.join(labels.select(F.col("node").alias("b"), "root"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("root").alias("low")))
        step = labels.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "low").alias("root"))
        step = cut(step)
        jump = step.select(F.col("node").alias("root"), F.col("root").alias("far"))
        new = cut(step.join(jump, "root", "left")
                  .select("node", "old", F.least("root", F.coalesce("far", "root")).alias("root")))
        changed = new.filter("root <> old").limit(1).count()
        labels = new.select("node", "root")
        if not changed:
            return labels
    raise RuntimeError(f"components did not settle in {rounds} rounds")
