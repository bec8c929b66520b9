"""Connected components of a graph that is a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import Scratch


def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """`v`, `root` for every end of an edge: the smallest vertex it is connected to.

    `edges` has `a` and `b`; direction, repetition and loops do not matter. Every round
    each vertex points to its smallest neighbour, pointers are followed to their roots by
    doubling, and the graph shrinks to its roots, so rounds grow with the logarithm of
    the graph. A hub is a key of joins that Spark may split; no neighbourhood is gathered.
    """
    edges, at = scratch.keep(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    found, found_at = None, None
    while True:
        both = edges.select("a", "b").union(edges.select("b", "a"))
        parents, path = scratch.keep(both.groupBy(F.col("a").alias("v")).agg(F.least(F.col("v"), F.min("b")).alias("p")))
        while True:
            above = parents.select(F.col("v").alias("p"), F.col("p").alias("up"))
            jumped, next_path = scratch.keep(
                parents.join(above.hint("shuffle_hash"), "p").select("v", F.col("up").alias("p"), (F.col("up") != F.col("p")).alias("moved"))
            )
            scratch.drop(path)
            parents, path = jumped.select("v", "p"), next_path
            if jumped.where("moved").isEmpty():
                break
        if found is None:
            found, found_at = parents.select("v", F.col("p").alias("root")), path
        else:
            step = parents.select(F.col("v").alias("root"), F.col("p").alias("up"))
            merged, merged_at = scratch.keep(found.join(step.hint("shuffle_hash"), "root", "left").select("v", F.coalesce("up", "root").alias("root")))
            scratch.drop(found_at)
            found, found_at = merged, merged_at
        ends = {c: parents.select(F.col("v").alias(c), F.col("p").alias(f"r{c}")).hint("shuffle_hash") for c in ("a", "b")}
        shrunk = edges.join(ends["a"], "a").join(ends["b"], "b").where("ra <> rb")
        edges_next, next_at = scratch.keep(shrunk.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct())
        scratch.drop(at)
        edges, at = edges_next, next_at
        if edges.isEmpty():
            return found
