"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from docindex.llm.scratch import stored


def _with_least(pairs: DataFrame) -> DataFrame:
    """(u, v) plus the least of u and all its v. The join's large side can be split at runtime."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(least, "u")


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Every node points to one root, and no root points on: nothing is left to do."""
    ends = edges.select(F.col("a").alias("node"), F.col("b").alias("to"), F.lit(0).alias("root")).union(
        edges.select("b", F.lit(None).cast("long"), F.lit(1)))
    found = ends.groupBy("node").agg(F.min("to").alias("x"), F.max("to").alias("y"), F.max("root").alias("root"))
    return found.where("x <> y OR x IS NOT NULL AND root = 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of the ``edges`` (a, b); root is the least node of its component.

    The edge list shrinks towards one star a component in about log(n) rounds; each is written to the
    shared folder. Self-loops and repeated edges are fine; no edge gives no row.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "edges")
    while not _is_forest_of_stars(now):
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        down = _with_least(large)
        small = (down.select(F.col("v").alias("a"), F.col("m").alias("b"))
                 .union(down.select(F.col("u").alias("a"), F.col("m").alias("b"))).where("a <> b").distinct())
        now = stored(small, "edges")
    now = now.distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b"), F.col("b")).distinct())
