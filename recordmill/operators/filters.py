"""Row filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def identified(name: Column, url: Column) -> Column:
    """A record is usable when it has a name or a source URL."""
    return (name != "") | (url != "")


def drop_unusable(df: DataFrame, name: str, url: str) -> DataFrame:
    return df.filter(identified(F.col(name), F.col(url)))


def up_to_page(df: DataFrame, page: str, last: int) -> DataFrame:
    return df.filter(F.col(page) <= last)
