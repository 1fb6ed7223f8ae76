"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.llm.common import stash

#: Rounds double the distance labels travel; this many cover any path that fits on a cluster.
MAX_ROUNDS = 64


def _both(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.*")


def _attach(links: DataFrame, roots: DataFrame) -> DataFrame:
    """Edges from each link's far end to the root of its near end; a node is no edge to itself."""
    return links.join(roots, "a").where(F.col("b") != F.col("root")).select(F.col("b").alias("a"), F.col("root").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a, b``), with ``root`` the smallest node it reaches.

    A large star hangs each larger neighbour on the smallest node around; a small star does the
    same with the smaller neighbours. The roots are sums by key with a partial step and the links
    stay spread as plain join rows, so a node with any number of links burdens no task. Each round
    is written to the shared folder. Rows with a null end or with equal ends link nothing.
    """
    current = stash(edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "components")
    before = None
    for _ in range(MAX_ROUNDS):
        near = _both(current)
        roots = near.groupBy("a").agg(F.least("a", F.min("b")).alias("root"))
        large = _attach(near.where(F.col("b") > F.col("a")), roots).select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        large = stash(large, "components")
        roots = large.groupBy("a").agg(F.min("b").alias("root"))
        hung = roots.select("a", F.col("root").alias("b"))
        current = stash(_attach(large, roots).union(hung).where(F.col("a") != F.col("b")).select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "components")
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        current.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
