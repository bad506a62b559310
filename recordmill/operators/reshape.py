"""Rows from arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def numbered_items(df: DataFrame, array: Column, ordinal: str, item: str, keep: list[str | Column]) -> DataFrame:
    """One row per array item with its 1-based ``ordinal``; empty and null arrays give none.

    The outer form with a filter behind it is on purpose: for the inner form
    the optimizer adds a filter on the size of the array in front, and so
    computes a costly array several times.
    """
    items = df.select(*keep, F.posexplode_outer(array).alias("_at", item))
    found = items.filter(F.col("_at").isNotNull())
    return found.withColumn(ordinal, F.col("_at") + 1).drop("_at")
