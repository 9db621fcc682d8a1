"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from casequarry.storage import materialize


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The written edges, and their number and a sum of hashes, counted as they are written."""
    state = Observation()
    edges = edges.observe(
        state,
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("high", "low").cast("decimal(38,0)")).alias("hashes"),
    )
    written = materialize(edges, "component-edges")
    return written, (state.get["n"], state.get["hashes"])


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest node of its neighbourhood."""
    both = edges.select(F.col("high").alias("node"), F.col("low").alias("other")).unionByName(
        edges.select(F.col("low").alias("node"), F.col("high").alias("other"))
    )
    least = both.groupBy("node").agg(F.min("other").alias("least"))
    root = F.least("least", "node")
    return (
        both.where(F.col("other") > F.col("node"))
        .join(least, "node")
        .select(F.col("other").alias("high"), root.alias("low"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them; edges may repeat."""
    least = edges.groupBy("high").agg(F.min("low").alias("least"))
    moved = (
        edges.join(least, "high")
        .where(F.col("low") != F.col("least"))
        .select(F.col("low").alias("high"), F.col("least").alias("low"))
    )
    own = least.select("high", F.col("least").alias("low"))
    return moved.unionByName(own).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of ``edges (a, b)``; the label is the smallest node.

    Minima are combined before they move, so a hub with many neighbours is one row per task there;
    the joins are on the node and can be split where it is skewed.
    """
    high, low = F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")
    current, state = _written(edges.where(F.col("a") != F.col("b")).select(high, low).distinct())
    while state[0]:
        before = state
        # Written between the stars, as the second reads it several times and each has a small plan.
        hung = materialize(_large_star(current), "component-stars")
        current, state = _written(_small_star(hung))
        if state == before:
            break
    roots = current.select(F.col("low").alias("node"), F.col("low").alias("label")).distinct()
    return current.select(F.col("high").alias("node"), F.col("low").alias("label")).unionByName(
        roots
    )
