"""Connected components of an edge table, in SQL: alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from askloom.llm.common import staged


def connected_components(edges: DataFrame, *, max_rounds: int = 60) -> DataFrame:
    """``node, component`` for every node of an edge table ``a, b``; the component is its smallest node.

    Each round hangs every neighbour onto the smallest node around (Kiveris et al., Connected
    Components in MapReduce and Beyond), so the number of rounds grows with the logarithm of the
    size. Neighbours are never gathered: a star with a third of all nodes is a minimum and a join.
    """
    links = staged(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "links",
    )
    before = None
    for _ in range(max_rounds):
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first()
        if state == before:
            return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = state
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = staged(
            both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct(),
            "large-star",
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        links = staged(
            large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct(),
            "small-star",
        )
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
