"""Connected components by alternating large-star and small-star rounds; every round is a Spark job on edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import by_frequency, written

ROUNDS = 60


def _near(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _star(near: DataFrame, large: bool) -> DataFrame:
    """Ties every larger (large) or smaller neighbour of u to the least of u and its neighbours."""
    least = written(near.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count("*").alias("n")), "least")
    joined = by_frequency(near, least, "u").drop("n")  # the middle of a large star has very many edges
    if large:
        return joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(own).filter("u <> v").distinct()


def _all_stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one smaller node, which hangs on none."""
    down, up = F.count(F.when(F.col("v") < F.col("u"), 1)), F.count(F.when(F.col("v") > F.col("u"), 1))
    return _near(edges).groupBy("u").agg(down.alias("down"), up.alias("up")).filter("down > 1 OR (down = 1 AND up > 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node reachable, for every node of the edges (u, v)."""
    edges = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "edges")
    for _ in range(ROUNDS):
        if _all_stars(edges):
            tops = edges.select(F.col("v").alias("node")).distinct()
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(tops.select("node", F.col("node").alias("component")))
        edges = written(_star(_star(_near(edges), True), False), "edges")
    raise RuntimeError("components did not settle")
