"""Connected components of a link table, without gathering any neighbourhood in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.tables import written


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links (a, b)``; the component is its smallest node.

    Alternating stars: each round hangs the larger neighbours of a node, then the smaller ones, on
    its smallest neighbour. Minima have a map-side part and rows are joined back to them, so a node
    with very many links is never held in one row. Rounds stop when the links no longer change; links
    with a null end or to themselves are dropped, no links give no rows.
    """
    edges = written(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter("u > v")
        .distinct(),
        "links",
    )
    before = None
    while (now := _checksum(edges)) != before:
        before = now
        if now[0] == 0:
            break
        edges = written(_small_star(_large_star(edges)), "links")
    ends = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return ends.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    hung = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.filter("u > v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    hung = joined.filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
