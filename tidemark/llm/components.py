"""Connected components of a graph held as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import durable


class UnionFind:
    """Disjoint sets over 0..n-1; the smallest member is the root."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        p = self.parent
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    def union(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(low, "u").where("v <> m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
    return moved.unionByName(low.withColumnRenamed("m", "v")).distinct()


def components(edges: DataFrame, *, most_rounds: int = 60) -> DataFrame:
    """(u, v): every node that isn't the smallest of its component, with the smallest. Edges (u, v) of longs; loops count for nothing.

    Alternates large-star and small-star steps, which need O(log^2 n) rounds and only minima by node;
    each round is written to the shared folder.
    """
    e = durable(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = None
    for _ in range(most_rounds):
        mark = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
        if tuple(mark) == state:
            return e
        state = tuple(mark)
        if not mark["n"]:
            return e
        e = durable(_small_star(_large_star(e)))
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
