"""Connected components of an edge table, by alternating large and small stars.

Every round replaces edges by edges to smaller nodes, until each node hangs on the
smallest one it can reach. Edges never leave the cluster; the driver sees two numbers a
round. Each round is written and read back, so lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.session import materialise


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("digest"),
    ).first()
    return row["n"], row["digest"]


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node with the smallest one of its surroundings."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (
        both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours with the smallest of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: integers), root the smallest of its part.

    Loops and repeated edges do no harm; no edges give no rows.
    """
    edges = materialise(edges.where("a <> b").distinct(), "components")
    state = _state(edges)
    while state[0]:
        edges = materialise(
            _small_star(_large_star(edges).where("a <> b").distinct()).where("a <> b").distinct(),
            "components",
        )
        before, state = state, _state(edges)
        if state == before:
            break
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
