"""Connected components by alternating stars, each round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyframe.session import written


def connected(links: DataFrame, path: str) -> DataFrame:
    """(node, root) for each node of the links (a, b); the root is the smallest node of the component.

    A round hangs the larger neighbours of each node on the smallest one, then the smaller ones; the number of
    rounds grows with the logarithm of the longest path. Each step is a mergeable minimum and a join, so a node
    with very many neighbours is never gathered. The rounds end when each component is a star around its smallest node.
    NULL and self links are ignored; without links there are no rows.

    Both sides of its joins are dealt by node anyway. They are merged: a broadcast of a small one would only add a job, and a relation on the driver, to each of many rounds.
    """
    edges = links.where("a != b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct()
    for step in range(1_000):
        # Written also before the first round, which reads the links several times.
        edges = written(edges, f"{path}/{step}")
        if _stars(edges):
            break
        # No larger neighbour is the smallest one, so what hangs on others tells all.
        least = edges.groupBy(F.col("v").alias("u")).agg(F.min("u").alias("m"))
        large = edges.join(least.hint("merge"), "u", "left").select("v", F.coalesce("m", "u").alias("u"))
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        both = large.join(least.hint("merge"), "v").select(F.explode(F.array("v", "u")).alias("v"), F.col("m").alias("u"))
        edges = both.where("v != u").distinct()
    roots = edges.select(F.col("v").alias("node"), F.col("u").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether each node that hangs on another hangs on only one, and none hangs on it."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("v").alias("node"), F.lit(1).alias("down")), F.struct(F.col("u").alias("node"), F.lit(0).alias("down")))).alias("end"))
    nodes = ends.groupBy("end.node").agg(F.sum("end.down").alias("down"), F.min("end.down").alias("least"))
    return not nodes.agg(F.max((F.col("down") > 1) | (F.col("down") > F.col("least")))).first()[0]
