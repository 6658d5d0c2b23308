"""Connected components of an edge table by alternating large-star and small-star rounds."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vela.llm.common import cut


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star round; ``edges`` holds (a, b) with a > b.

    Large star looks at all neighbours of a node, small star at the smaller ones;
    the minimum is an aggregate (pre-combined), and the join back to the edges is a
    plain equality join that adaptive execution may split at a hub.
    """
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    low = both.groupBy("a").agg(F.min("b").alias("m"))
    low = low.select(F.col("a").alias("node"), F.least("a", "m").alias("m"))
    near = both.join(low, both.a == low.node)
    if large:
        out = near.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = near.select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
    return out.where("a <> b").distinct()


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the smallest node of its component.

    Self-loops and nulls are ignored, so a node without a real edge does not
    appear.  Runs until the edge set no longer changes; each round is a reliable
    checkpoint.
    """
    now = cut(edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
              .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _state(now)
    while state[0]:
        after = cut(_star(_star(now, large=True), large=False))
        moved = _state(after)
        if moved == state:
            break
        now, state = after, moved
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b"), F.col("b"))).distinct()
