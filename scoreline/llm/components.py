"""Connected components of links as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle


def connect(links: DataFrame) -> DataFrame:
    """(node, root) of every node that some link (a, b) touches; the root is the smallest node reached.

    Links turn into stars by turns: every node hands its smallest neighbour to its
    larger neighbours, then to its smaller ones, until nothing changes. A turn keeps
    the number of links, combines before it shuffles, and is written to the shared
    folder. Chains halve with each turn.
    """
    edges = settle(links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    if edges.isEmpty():
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Large star: the larger neighbours of u, and u itself, move to the smallest of all.
        least = both.groupBy("u").agg(F.min("v").alias("least")).withColumn("least", F.least("u", "least"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        large = large.unionByName(least.where("least < u").select("u", F.col("least").alias("v"))).where("u != v").distinct()
        large = settle(large, "large-star")
        # Small star: each node keeps its smallest neighbour, to which its other ones move.
        small = large.groupBy("u").agg(F.min("v").alias("least"))
        moved = large.join(small, "u").where("v != least").select(F.col("v").alias("u"), F.col("least").alias("v"))
        new = settle(moved.unionByName(small.select("u", F.col("least").alias("v"))).distinct(), "small-star")
        if _same(edges, new):
            return new.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
        edges = new


def _same(old: DataFrame, new: DataFrame) -> bool:
    def total(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v") % 1_000_003)).first()

    return total(old) == total(new)
