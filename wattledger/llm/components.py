"""Connected components of links, and the blocks in which large groups are compared."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def _look_up(edges: DataFrame, least: DataFrame) -> DataFrame:
    # `least` is a written table, so Spark can split the join where one node has very many links.
    return edges.join(stage(least, "least"), "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _look_up(both, least).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = _look_up(edges, least)
    moved = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(joined.select("u", F.col("m").alias("v"))).distinct()


def connected(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): the smallest node reachable from each node that has a link; roots are left out.

    Alternates large-star and small-star steps, each a written table, until no link changes. Neither gathers a node's
    links, and the number of rounds grows with the logarithm of the longest chain.
    """
    edges = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges, before = stage(edges, "links"), None
    while True:
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before or mark[0] == 0:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = mark
        edges = stage(_small_star(stage(_large_star(edges), "links")), "links")


class Union:
    """Components of the few nodes that one task sees."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.find(i), self.find(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)
