"""Connected components of an edge table by alternating large-star and small-star steps.

Every round aggregates the edges twice and joins them with the results; it is stored
in the shared folder, so lineage stays short and lost executors cost one round.  Of a
vertex only its smallest neighbour is computed, never a list of neighbours; in the
joins its edges meet in one task unless the session lets Spark split skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwise.llm.common import stored

#: rounds grow with the logarithm of the longest path; more than this means an error
MAX_ROUNDS = 60


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(vertex, component) for every vertex of the edges; a component is named by its smallest vertex.

    Edges with a null end are ignored, repeated edges and loops change nothing.
    """
    pairs = stored(edges.select(F.least(a, b).alias("low"), F.greatest(a, b).alias("high"))
                   .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct(), "edges")
    vertices = pairs
    for _ in range(MAX_ROUNDS):
        # large star: larger neighbours of a vertex move to its smallest neighbour (or itself)
        both = pairs.select(F.col("low").alias("v"), F.col("high").alias("n")).union(pairs.select(F.col("high"), F.col("low")))
        least = both.groupBy("v").agg(F.least(F.min("n"), F.col("v")).alias("m"))
        large = (both.where("n > v").join(least, "v").select(F.col("m").alias("low"), F.col("n").alias("high")).distinct())
        # small star: a vertex and its smaller neighbours move to the smallest of them
        smallest = large.groupBy("high").agg(F.min("low").alias("m"))
        moved = large.join(smallest, "high")
        small = (moved.where("low <> m").select(F.col("m").alias("low"), F.col("low").alias("high"))
                 .union(smallest.select(F.col("m").alias("low"), "high")).distinct())
        after = stored(small, "edges")
        # done when all edges lead from a component's smallest vertex: no vertex is both a low and a high end
        if not after.join(after.select(F.col("low").alias("high")).distinct(), "high", "left_semi").head(1):
            ends = after.groupBy("high").agg(F.min("low").alias("low"), F.count("*").alias("n"))
            if not ends.where("n > 1").head(1):
                own = vertices.select(F.col("low").alias("vertex")).union(vertices.select("high")).distinct()
                found = ends.select(F.col("high").alias("vertex"), F.col("low").alias("component"))
                return own.join(found, "vertex", "left").select("vertex", F.coalesce("component", "vertex").alias("component"))
        pairs = after
    raise RuntimeError("the components did not settle")
