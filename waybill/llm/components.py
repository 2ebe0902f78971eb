"""Connected components of a graph given as a table of edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from waybill.storage import Folder, as_table, new_folder


def _least(pairs: DataFrame) -> DataFrame:
    """u and the least of its v. Combines before it shuffles, so a node with very many edges costs one row a task."""
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """node, label: every node of an edge (u, v) and the least node of its component. Nodes are numbers; loops and repeated edges do no harm.

    Large stars hang every larger neighbour of a node on the least one, small stars hang a node and its smaller neighbours there; a round of
    both keeps components and shortens them by about half, and when nothing moves each edge is (node, least). Every round is a written table.
    """
    spark = edges.sparkSession
    now = as_table(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), path := new_folder(spark, "edges"))
    before = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = _least(both).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = as_table(large, large_path := new_folder(spark, "edges"))
        # Every edge points from the larger to the smaller node here.
        low = _least(large)
        small = large.join(low.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(low.select("u", F.col("m").alias("v")))
        after = as_table(small.distinct(), next_path := new_folder(spark, "edges"))
        state = tuple(after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        for old in (path, large_path):
            Folder(spark, old).remove()
        now, path = after, next_path
        if state == before:
            break
        before = state
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return stars.union(stars.select("label", "label")).distinct()
