"""Connected components of a link table, by alternating star operations.

Every round links each node's larger neighbours to its smallest one, then its smaller ones; links
shrink to stars around the smallest node in a logarithmic number of rounds. Each round is written
to the shared folder, so plans stay short and lost executors cost one round at most. Nothing is
collected but two numbers per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, label) of all nodes in ``links`` (a, b long): label is the smallest node reachable."""
    a, b = F.col("a"), F.col("b")
    pairs = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(a != b).distinct()
    pairs = written(pairs, "links")
    seen = None
    while seen != (seen := _digest(pairs)):
        pairs = written(_small_star(_large_star(pairs)), "links")
    centers = pairs.select(b.alias("node"), b.alias("label")).distinct()
    return pairs.select(a.alias("node"), b.alias("label")).unionByName(centers)


def _digest(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def _large_star(pairs: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of node and neighbours."""
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(pairs: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    pairs = pairs.where(F.col("a") != F.col("b"))
    least = pairs.groupBy("a").agg(F.min("b").alias("m"))
    moved = pairs.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
