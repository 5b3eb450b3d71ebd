"""Connected components of an undirected edge table, by alternating large-star and small-star rounds.

Every round is two shuffles over edges (u, v); the number of rounds grows with the logarithm of the
longest path. No vertex gathers its neighbours in one task: minima are aggregated map-side and joined
back, and the rows of hubs, of which there is a bounded number, meet their minimum by broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.operators.skew import join_spread
from gleanery.session import cut, uncut


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    """Every neighbour above u is linked to the least of u and its neighbours."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
    return join_spread(both.where("v > u"), least, "u", "n", 2 * total).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    """u and its neighbours below it are linked to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    moved = join_spread(down, least, "u", "n", total).where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def _sign(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, src: str = "u", dst: str = "v", max_rounds: int = 60) -> DataFrame:
    """Return (node, component): component is the least node that can be reached. Nodes without an edge
    to another node don't appear; nulls and self-loops are ignored; an empty table gives an empty result."""
    now = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u <> v")
    now = cut(now.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = _sign(now)
    for _ in range(max_rounds):
        new = cut(_small_star(_large_star(now, before[0]).distinct(), before[0]).distinct()) if before[0] else now
        sign = _sign(new)
        if sign == before:
            # A fixed point is a forest of stars: each node points at the least of its component.
            return new.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(new.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        uncut(now)
        now, before = new, sign
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
