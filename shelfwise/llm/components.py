"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.scratch import written


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node are linked to its smallest."""
    both = _both(edges)
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    moved = both.join(least, "a").filter(F.col("b") > F.col("a"))
    return moved.select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node, are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b")))


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("sum")).first()
    return r["n"], r["sum"]


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for the nodes of ``links`` (``a``, ``b``).

    Each round is written to the shared folder; rounds end when the stars no longer change.
    """
    edges = written(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "stars")
    before = None
    while (now := _state(edges)) != before:
        before = now
        if not now[0]:
            break
        large = _large_star(edges).filter("a <> b").distinct()
        edges = written(_small_star(large).filter("a <> b").distinct(), "stars")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
