"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caremesa.llm.common import c, settle


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the node's smallest neighbour or itself."""
    both = edges.union(edges.select(c("b").alias("a"), c("a").alias("b")))
    least = settle(both.groupBy("a").agg(F.least(F.min("b"), c("a")).alias("m")))
    return both.where(c("b") > c("a")).join(least, "a").select(c("b").alias("a"), c("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them. ``a`` is the larger end."""
    least = settle(edges.groupBy("a").agg(F.min("b").alias("m")))
    moved = edges.join(least, "a").where(c("b") != c("m")).select(c("b").alias("a"), c("m").alias("b"))
    return moved.union(least.select("a", c("m").alias("b"))).distinct()


def _trace(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first())


def roots(edges: DataFrame) -> DataFrame:
    """Each node that has a link to another, with the smallest node of its component.

    ``edges`` has whole-number columns a and b; direction, repeats and loops don't
    matter. Returns node, root. Only counts and one checksum reach the driver. Joins
    meet written tables, so that adaptive execution can split a node with many links.
    """
    current = settle(
        edges.where(c("a") != c("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before = _trace(current)
    while before[0]:
        current = settle(_small_star(settle(_large_star(current))))
        after = _trace(current)
        if after == before:
            break
        before = after
    return current.select(c("a").alias("node"), c("b").alias("root")).union(current.select(c("b").alias("node"), c("b").alias("root")).distinct())
