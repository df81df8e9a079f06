"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from torqline.llm.common import stored


def _starred(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (u > v) after one star operation: neighbours hang on the smallest node around them."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    # Written, so that both sides of the join are plain shuffles and the edges of a hub can be split over tasks.
    least = stored(least, "least")
    joined = both.join(least, "u")
    if large:
        moved = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return moved.filter("u != v").distinct()


def components(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """node and component (its smallest reachable node) for all nodes of ``links`` (a, b) but the smallest ones.

    With ``rounds`` it stops after as many; components may then still be split.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct()
    before, turn = None, 0
    while rounds is None or turn < rounds:
        edges = stored(_starred(_starred(edges, True), False), "stars")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        turn += 1
        if tuple(state) == before:
            break
        before = tuple(state)
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
