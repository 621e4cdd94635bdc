"""Connected components by alternating large-star and small-star steps, without a graph on the driver.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014). Each round is two joins against a minimum per
node; the edge list is written to the shared folder after each round, and only two numbers come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestry.llm.common import forget, written


def _large(edges: DataFrame) -> DataFrame:
    """Links each larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    return both.join(low, both.a == low.u).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """edges: a > b. Links each smaller neighbour of a node, and the node, to the smallest neighbour."""
    low = edges.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
    rest = edges.join(low, edges.a == low.u).where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """edges (a, b) of any ordered type, in any direction, repeated or not -> (node, label), label being the smallest node reachable.

    Nodes without an edge to another node don't appear; null ends are dropped. An empty input gives an empty result.
    """
    start = edges.select("a", "b").where("a <> b")
    now = written(start.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    for _ in range(rounds):
        mark = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if mark == before or not mark[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
        before = mark
        last, now = now, written(_small(_large(now)), "edges")
        forget(last)
    raise RuntimeError(f"components did not settle in {rounds} rounds")
