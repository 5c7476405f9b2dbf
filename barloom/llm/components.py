"""Connected components of a link table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links (a, b)``; the component is its least node.

    Each round points every node to its least neighbour, follows the pointers to their ends by
    doubling, and replaces the nodes of the links by these; links inside a node vanish. A chain
    whose ids rise is one round and the logarithm of its length in doublings. All steps are
    joins and hash aggregates of links, which shrink from round to round; nothing is collected.
    A node with very many links costs one aggregated row for each task.
    """
    edges = written(links.select("a", "b").filter("a <> b").distinct(), "links")
    both = edges.select(F.col("a").alias("node")).union(edges.select(F.col("b"))).distinct()
    labels = written(both.select("node", F.col("node").alias("component")), "labels")
    while not edges.isEmpty():
        ends = edges.select("a", "b").union(edges.select("b", "a"))
        least = ends.groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("p"))
        least = written(least, "pointers")
        while True:
            onward = least.select(F.col("a").alias("p"), F.col("p").alias("q"))
            jump = written(least.join(onward, "p").select("a", "p", "q"), "jumps")
            if jump.filter("p <> q").isEmpty():
                break
            least = jump.select("a", F.col("q").alias("p"))
        to_a, to_b = jump.select("a", F.col("q").alias("x")), jump.select(F.col("a").alias("b"), F.col("q").alias("y"))
        edges = written(
            edges.join(to_a, "a").join(to_b, "b").filter("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(),
            "links",
        )
        moved = jump.select(F.col("a").alias("component"), "q")
        labels = written(
            labels.join(moved, "component", "left").select("node", F.coalesce("q", "component").alias("component")), "labels"
        )
    return labels
