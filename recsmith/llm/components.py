"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsmith.llm.common import written


def connected_components(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """(node, root) for every node of `edges` (columns a, b; any orderable
    type): root is the least node of its component. Large-star and small-star
    steps alternate until all that is left are stars; each is a join on the
    node with map-side combined minima, so no neighbourhood is collected.
    Links never leave the executors: the driver sees whether a node is left
    that is no star's. Self links and repeated links are harmless; no links
    give no rows."""
    current = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v")
    for _ in range(rounds):
        # large star: neighbours above a node hang onto its least neighbour
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        # small star: neighbours below a node, and the node, hang onto the least
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        current = written(large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                          .union(low.select("u", F.col("m").alias("v"))).filter("u != v").distinct())
        places = current.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("low")).union(
            current.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("low")))
        mixed = places.groupBy("node").agg(F.sum("up").alias("up"), F.max("low").alias("low")).filter("up + low > 1")
        if mixed.isEmpty():
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
