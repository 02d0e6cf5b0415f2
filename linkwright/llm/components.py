"""Connected components by alternating stars, with partially aggregated minima and no collected neighbourhoods."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkwright.llm.shared import forget, materialize


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return least.select("a", F.col("m").alias("b")).unionByName(moved.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))).distinct()


def components(edges: DataFrame, *, rounds: int = 60) -> DataFrame:
    """node and component (the smallest node that it reaches) of every node that has an edge in edges(a, b).

    Self-loops, repeated edges and nulls are left out; no edges give no rows. Each round writes its edges to the shared
    folder. A node with a third of all edges is aggregated before the shuffle, and its join is one that Spark can split.
    """
    edges = edges.select("a", "b").where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = materialize(edges, "edges")
    mark = None
    for _ in range(rounds):
        n, total = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if not n or (n, total) == mark:
            break
        mark = (n, total)
        after = materialize(_small(_large(now)), "edges")
        forget(now)
        now = after
    else:
        raise RuntimeError("the components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
