"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroute.llm.staging import stage

MAX_ROUNDS = 60


def _neighbour_minimum(directed: DataFrame) -> DataFrame:
    # pre-aggregated on the map side, so a hub costs one row per task
    return (directed.groupBy("u").agg(F.min("v").alias("m"))
            .select("u", F.least("u", "m").alias("m")))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (both.join(_neighbour_minimum(both), "u")
            .where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _neighbour_minimum(down)
    linked = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, name: str = "components", rounds: int | None = None,
               files: int | None = None) -> DataFrame:
    """(node, component) of an undirected edge list (u, v); component is the least node.

    Each round is written to the shared folder; rounds end when the edge set
    repeats.  Loops and repeated edges are harmless; nodes without an edge do
    not appear.  Nulls on either side are ignored.

    With ``rounds`` it ends after so many, settled or not: nodes of one component are
    connected still, but connected nodes may be in several.  ``files`` bounds the files
    that a round writes.
    """
    clean = lambda e: e.where(F.col("u") != F.col("v")).distinct()
    written = lambda e: stage(e.coalesce(files) if files else e, name)
    nodes = edges.select("u", "v").dropna()
    current = written(clean(nodes.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))))
    seen = None
    for _ in range(rounds or MAX_ROUNDS):
        current = written(clean(_small_star(clean(_large_star(current)))))
        if rounds:
            continue
        state = current.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if state == seen:
            break
        seen = state
    else:
        if not rounds:
            raise RuntimeError("components did not settle")
        own = current.select(F.col("v").alias("u"), "v")
        return (current.unionByName(own).groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
