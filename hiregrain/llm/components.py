"""Connected components of a graph of any size by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hiregrain.llm.common import stored


def _stars(edges: DataFrame, small: bool) -> DataFrame:
    """One contraction: neighbours of a node move to the smallest of them.

    ``edges`` are (a, b) with a > b. Large star: each larger neighbour of a node links to the
    node's smallest neighbour (or itself); small star: the node and its smaller neighbours do.
    The minimum is a partial aggregate and is joined back, so that a hub is never gathered.
    """
    if small:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        moved = edges.join(least, "a")
        found = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b"))
        )
    else:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        found = (
            both.join(least, "u")
            .where("v > u")
            .select(F.col("v").alias("a"), F.least("u", "m").alias("b"))
        )
    return found.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node it reaches.

    Each round keeps the edges in the shared folder. Rounds end when every component is a star;
    their number grows with the logarithm of the longest chain. No edge gives no row.
    """
    current = edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    current = stored(current.distinct())
    before = None
    while True:
        current = stored(_stars(_stars(current, small=False), small=True))
        # Equal numbers and hash sums of the edges mean that nothing moved.
        now = current.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if now == before:
            break
        before = now
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
