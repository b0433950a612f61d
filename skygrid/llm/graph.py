"""Connected components of an edge table, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skygrid.llm.common import is_empty, written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b long); root is the smallest node reachable.

    Alternates two steps until nothing changes: larger neighbours are linked to the smallest neighbour, then
    every node's smaller neighbours are. Each step keeps the number of edges, and the number of rounds grows with
    the logarithm of the largest component. Each round is a written table, so a lost executor costs one round.
    """
    now = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    if is_empty(now):
        return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    while True:
        # Edges go from the larger node u to the smaller v.
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        wide = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        wide = written(wide, "edges")
        small = wide.groupBy("u").agg(F.min("v").alias("m"))
        near = (
            wide.join(small, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(small.select("u", F.col("m").alias("v"))).distinct())
        near = written(near, "edges")
        # A forest of stars: no node is both a root and a leaf, and no leaf has two roots.
        roots = near.select(F.col("v").alias("u")).distinct()
        linked = near.join(roots, "u", "left_semi")
        twice = near.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        now = near
        if is_empty(linked) and is_empty(twice):
            return near.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                near.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
