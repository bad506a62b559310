"""Paged listings: read on until the first empty or failed page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.operators.filters import up_to_page
from recordmill.operators.joins import lookup_join


def take_while(
    df: DataFrame, listing: str, page: str, stops: Column, max_pages: int | None = None
) -> DataFrame:
    """Rows of each listing before its first page where ``stops`` holds.

    The first stop per listing comes from one combined aggregate and is joined
    back, which keeps a listing with very many pages spread over tasks; a running
    window over the listing would not. ``max_pages`` also ends every listing there.
    """
    bounded = df if max_pages is None else up_to_page(df, page, max_pages)
    stopped = bounded.filter(stops).groupBy(listing).agg(F.min(page).alias("_stop"))
    joined = lookup_join(bounded, stopped, listing)
    return joined.filter(F.col("_stop").isNull() | (F.col(page) < F.col("_stop"))).drop("_stop")


def listing_pages(log: DataFrame, max_pages: int | None = None) -> DataFrame:
    """Pages of a crawl log ``(listing, page, n_records, failed)`` that count."""
    return take_while(log, "listing", "page", (F.col("n_records") == 0) | F.col("failed"), max_pages)
