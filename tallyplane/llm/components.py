"""Connected components over an edge table: alternating large-star and small-star steps, each a minimum by key and a join back.

The minimum combines before the shuffle and the join can be split where a key is hot, so that a
star with a third of all nodes is no problem. Each round is written to the shared folder, and the one before it deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, staged


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    every = _both(edges)
    low = every.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
    return every.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u")
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).where("u <> v")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge; root is the smallest node of its component. edges: u, v."""
    now = staged(edges.select("u", "v").where("u <> v").distinct(), "edges")
    while True:
        nxt = staged(_small_star(_large_star(now)).distinct(), "edges")
        # settled: every node points at a root, and no root points anywhere
        loose = nxt.join(nxt.select(F.col("u").alias("v")).distinct(), "v", "left_semi").limit(1).count()
        several = nxt.groupBy("u").count().where("count > 1").limit(1).count() if not loose else 1
        discard(now)
        now = nxt
        if not loose and not several:
            break
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
