"""Projections: normalise, align, reorder, merge by name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from recordmill.functions.text import norm_ws


def column_or_empty(df: DataFrame, name: str) -> Column:
    """The column, or '' where the source does not have it."""
    return F.col(name) if name in df.columns else F.lit("")


def normalise_strings(df: DataFrame) -> DataFrame:
    """White space of every string column made tidy, in one projection."""
    return df.select(
        *[
            norm_ws(F.col(field.name)).alias(field.name) if isinstance(field.dataType, StringType) else F.col(field.name)
            for field in df.schema.fields
        ]
    )


def leading(df: DataFrame, preferred: list[str]) -> DataFrame:
    """Preferred columns first, all others after them in their own order."""
    return df.select(*preferred, *[name for name in df.columns if name not in preferred])


def merge_by_name(frames: list[DataFrame]) -> DataFrame:
    """Union by column name; columns of the first table come first, gaps are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
