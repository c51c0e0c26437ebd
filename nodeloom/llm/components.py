"""Connected components of a link table by alternating star contraction.

Every node moves its links to the smallest node that it knows; large-star and
small-star steps alternate until nothing changes. Each round is two grouped
aggregations, its result is checkpointed, and only counts and one checksum reach
the driver. A node's smallest neighbour is aggregated in the tasks; hubs, which hold
more than a thousandth of all links, get it by broadcast (there are at most two
thousand of them), so a hub with a very large number of links never has to sit in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nodeloom.llm.common import cut, join_split


def _hang(edges: DataFrame, large: bool, total: int) -> DataFrame:
    """One star step over edges (a, b), a > b; ``total``: how many they are."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
    least = least.select("a", F.least("a", "m").alias("m"), "n") if large else least
    moved = join_split(both, least, "a", total)
    if large:
        return moved.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").distinct()
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(links: DataFrame, rounds: int = 100) -> DataFrame:
    """(node, component): the smallest node reachable from each node that has a link.

    links: columns a, b of comparable type. Nulls and self links are ignored,
    repeated links count once, an empty table gives an empty result.
    """
    edges = cut(links.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state, total = None, edges.count()
    for _ in range(rounds):
        edges = cut(_hang(cut(_hang(edges, True, total)), False, total))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state, total = now, now[0]
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
