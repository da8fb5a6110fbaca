"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014), all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborline.llm.common import checkpointed


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return down.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))


def _settled(edges: DataFrame) -> bool:
    """Whether every node that begins an edge begins one only and ends none."""
    ends = edges.select("a", F.lit(1).alias("o"), F.lit(0).alias("i")).union(edges.select("b", F.lit(0), F.lit(1)))
    return ends.groupBy("a").agg(F.sum("o").alias("o"), F.sum("i").alias("i")).where("o > 1 or (o > 0 and i > 0)").isEmpty()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) of every node of the edges (a, b), longs; root is the least node it is connected to.

    Each round is checkpointed to the shared folder. A chain of n nodes takes about log n rounds.
    """
    edges = checkpointed(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    for _ in range(most_rounds):
        if _settled(edges):
            break
        edges = checkpointed(_small_star(_large_star(edges)).where("a <> b").distinct())
    else:
        raise RuntimeError("components did not settle")
    roots = edges.groupBy("a").agg(F.min("b").alias("root"))
    return roots.select(F.col("a").alias("node"), "root").union(roots.select(F.col("root").alias("node"), "root").distinct())
