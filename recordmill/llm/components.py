"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordmill.llm.shared import settle


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges(a, b)``; root is the smallest node it reaches.

    Each step points the neighbours of a node at the smallest one, so the edges
    turn into stars in a logarithmic number of rounds. Rounds are settled; a
    node's neighbours are aggregated or joined, never gathered.
    """
    now = settle(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    while not _stars(now):
        now = _small(_large(now))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select("v", "v").distinct()
    )


def _stars(edges: DataFrame) -> bool:
    """Does every node either point to one other or is pointed at?"""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("into")).union(
        edges.select("v", F.lit(0), F.lit(1))
    )
    each = ends.groupBy("x").agg(F.sum("out").alias("out"), F.sum("into").alias("into"))
    return each.where("out > 1 or (out > 0 and into > 0)").isEmpty()


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = settle(both.groupBy("u").agg(F.min("v").alias("m")))
    pointed = both.join(least, "u").where("v > u").select("v", F.least("u", "m").alias("m"))
    return settle(pointed.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small(edges: DataFrame) -> DataFrame:
    least = settle(edges.groupBy("u").agg(F.min("v").alias("m")))
    pointed = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return settle(pointed.union(own).distinct())
