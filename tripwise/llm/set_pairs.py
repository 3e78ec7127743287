"""Exact Jaccard checks of candidate pairs of sets, in DataFrame expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: pairs of one partner that one task joins
PAIRS_PER_TASK = 512


def least_overlap(size: Column, percent: int) -> Column:
    """The overlap that a row needs at least: ceil(percent * size / 100)."""
    return F.floor((size * percent + 99) / F.lit(100)).cast("long")


def needed_overlap(size_a: Column, size_b: Column, percent: int) -> Column:
    """The overlap at which two sets of these sizes link: ceil(percent * (a + b) / (100 + percent))."""
    return F.floor(((size_a + size_b) * percent + 99 + percent) / F.lit(100 + percent))


def linked(pairs: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b) of keys those whose rows (key, size, columns) link; blocks of pairs share a partner's row."""
    counted = pairs.join(pairs.groupBy("a").agg(F.floor((F.count("*") - 1) / PAIRS_PER_TASK).cast("int").alias("last")), "a")
    dealt = counted.withColumn("block", F.pmod(F.xxhash64("b"), F.col("last") + 1).cast("int"))
    blocks = dealt.select("a", "block").distinct()
    of = lambda name: rows.select(F.col("key").alias(name), F.col("columns").alias("columns_" + name), F.col("size").alias("size_" + name))
    first = blocks.join(of("a"), "a")
    both = dealt.select("a", "block", "b").join(of("b"), "b").join(first, ["a", "block"])
    overlap = F.size(F.array_intersect("columns_a", "columns_b"))
    return (both.withColumn("overlap", overlap)
            .where(100 * F.col("overlap") >= percent * (F.col("size_a") + F.col("size_b") - F.col("overlap"))).select("a", "b"))
