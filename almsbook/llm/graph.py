"""Connected components as alternating joins and minima."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almsbook.sources.storage import materialize


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a, b)``: root is the smallest node connected to it.

    Large star, then small star, until the edges stay as they are. The smallest neighbour is a grouped
    minimum, which combines before the shuffle; the join that hands it back has one row per key on that
    side, so the adaptive skew join can split a node with very many neighbours. Each round is written,
    which cuts the lineage. No edges give no rows; loops and repeated edges are harmless.
    """
    current = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(), "edges")
    before = None
    while True:
        state = current.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        both = current.select("v", "u").unionByName(current.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = materialize(both.groupBy("v").agg(F.min(F.least("u", "v")).alias("m")), "least")
        # Large star: larger neighbours of v now hang on the smallest node around v.
        large = materialize(both.join(least, "v").where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u")).distinct(), "large")
        lowest = materialize(large.groupBy("v").agg(F.min("u").alias("m")), "lowest")
        # Small star: v and its smaller neighbours hang on the smallest of them.
        small = large.join(lowest, "v")
        current = materialize(
            small.where("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u"))
            .unionByName(lowest.select("v", F.col("m").alias("u"))).distinct(),
            "small",
        )
    return current.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(
        current.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()
    )
