"""Connected components by alternating stars, with every round kept as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.tables import store


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the least node of the neighbourhood."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """The smaller neighbours of a node, and the node, are tied to the least of them; edges have a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): root is the least node it can reach.

    Loops and repeated edges are allowed; a null end is not. Each round works on
    all edges in parallel, and the number of rounds grows with the logarithm of
    the components' size. Nothing is collected but a count.
    """
    oriented = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    kept = store(oriented, "edges")
    while True:
        grown = store(_small_star(_large_star(kept.df)), "edges")
        moved = grown.df.join(kept.df, ["a", "b"], "left_anti").limit(1).count()
        same = not moved and grown.df.count() == kept.df.count()
        kept.discard()
        kept = grown
        if same:
            break
    roots = kept.df.select(F.col("b").alias("node")).distinct()
    return kept.df.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        roots.select("node", F.col("node").alias("root")))
