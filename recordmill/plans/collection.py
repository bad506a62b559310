"""From a table of collected pages to the raw tables of a collection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.functions.urls import DOCUMENT_EXTENSIONS, DOCUMENT_PATHS
from recordmill.operators.filters import up_to_page
from recordmill.operators.listing import take_while
from recordmill.operators.pages import article_details, article_rows, articles_with_details, listed_articles, may_list_articles
from recordmill.session import settle


def collect_news(
    listings: DataFrame,
    articles: DataFrame,
    council: Column,
    domain: str,
    max_pages: int | None = None,
    fetch_details: bool = True,
    extensions: tuple[str, ...] = DOCUMENT_EXTENSIONS,
    paths: tuple[str, ...] = DOCUMENT_PATHS,
    retrieved_at: Column | None = None,
    excerpt_length: int | None = None,
    text_length: int | None = None,
) -> DataFrame:
    """News rows of the listing pages, each article once, with its own page's text if wanted.

    ``listings`` has ``(listing, page, url, html)``; a page without HTML failed.
    Each listing is read up to its first page that failed or has no article, and
    no further than ``max_pages`` if given. First a cheap test finds pages that can't
    have an article; only pages before the first of these are parsed, once, and what was
    found in them is settled before the exact stops are known. ``articles`` has ``(page_id, url, html)``;
    only those that a listing names are parsed. ``excerpt_length`` and
    ``text_length`` cut the texts; whole by default.
    """
    order = ["listing", "page"]
    read = listings if max_pages is None else up_to_page(listings, "page", max_pages)
    hopeful = take_while(read, "listing", "page", ~may_list_articles(F.col("url"), F.col("html"), domain))
    found = settle(listed_articles(hopeful, domain, order, excerpt_length=excerpt_length))
    counted = take_while(found, "listing", "page", F.size("articles") == 0)
    rows = article_rows(counted, council, order, retrieved_at)
    named = rows.select(F.col("article_url").alias("url")).distinct()
    wanted = articles.join(named, "url", "left_semi") if fetch_details else articles.limit(0)
    details = article_details(wanted, domain, ["page_id"], extensions, paths, text_length)
    return articles_with_details(rows, details, order)
