"""Links, articles and documents found in a table of collected pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.functions import html as H
from recordmill.functions import text as T
from recordmill.functions import urls as U
from recordmill.functions.dates import retrieval_stamp
from recordmill.functions.staging import let
from recordmill.operators.dedupe import first_by_key, first_by_long_key
from recordmill.operators.joins import enrich, lookup_join
from recordmill.operators.reshape import numbered_items
from recordmill.session import settle

# Columns of the collected tables, in their order.
RESOURCE_COLUMNS = [
    "council", "category", "year_raw", "document_title_raw",
    "document_url", "file_type", "source_page", "retrieved_at_utc",
]
NEWS_COLUMNS = [
    "council", "title_raw", "published_date_raw", "excerpt_raw",
    "article_url", "source_listing_page", "article_text_raw",
    "linked_document_urls", "retrieved_at_utc",
]


def page_links(pages: DataFrame, keep: list[str], html: str = "html", url: str = "url") -> DataFrame:
    """One row per link of a page: ``keep``, position, href, title and absolute URL.

    The URL is made inside the array, so that filters on it, which the optimizer
    moves down to the exploded rows, do not join it again.
    """
    prepared = pages.select(
        *keep, U.url_parts(F.col(url)).alias("_page"), H.anchors(H.visible(F.col(html))).alias("_anchors")
    )
    links = F.transform(
        "_anchors", lambda a: F.struct(a["href"].alias("href"), a["text"].alias("text"), U.url_join(F.col("_page"), a["href"]).alias("url"))
    )
    return numbered_items(prepared, links, "position", "_link", keep).select(
        *keep,
        "position",
        F.col("_link.href").alias("href"),
        F.col("_link.text").alias("link_title"),
        F.col("_link.url").alias("link_url"),
    )


def document_links(
    links: DataFrame,
    domain: str,
    extensions: tuple[str, ...] = U.DOCUMENT_EXTENSIONS,
    paths: tuple[str, ...] = U.DOCUMENT_PATHS,
) -> DataFrame:
    """Links with a title that lead to a document of the domain."""
    link = F.col("link_url")
    return links.filter(
        (F.col("link_title") != "") & U.in_domain(link, domain) & U.looks_like_document(link, extensions, paths)
    )


def document_index(
    pages: DataFrame,
    council: Column,
    category: Column,
    domain: str,
    order: list[str],
    extensions: tuple[str, ...] = U.DOCUMENT_EXTENSIONS,
    paths: tuple[str, ...] = U.DOCUMENT_PATHS,
    retrieved_at: Column | None = None,
) -> DataFrame:
    """Each document once, as first met in page ``order``."""
    labelled = pages.withColumns({"council": council, "category": category, "source_page": F.col("url")})
    keep = ["council", "category", "source_page", *[c for c in order if c not in ("council", "category", "source_page")]]
    found = document_links(page_links(labelled, keep), domain, extensions, paths)
    title, link = F.col("link_title"), F.col("link_url")
    rows = found.select(
        *keep,
        "position",
        T.bounded_year(title).alias("year_raw"),
        U.title_or_file_name(title, link).alias("document_title_raw"),
        link.alias("document_url"),
        U.file_type(link).alias("file_type"),
    )
    first = first_by_key(rows, "document_url", [*order, "position"])
    stamp = retrieval_stamp() if retrieved_at is None else retrieved_at
    return first.withColumn("retrieved_at_utc", stamp).select(*RESOURCE_COLUMNS)


def _article(page: Column, link: Column, body: Column, domain: str, length: int | None) -> Column:
    """Record of one article from its title link and its HTML; null where it is none.

    The text is only read where the link names an article of the domain.
    """

    def record(named: Column) -> Column:
        return let(
            H.text_of(body),
            lambda text: F.struct(
                named["title"].alias("title_raw"),
                T.published_date(text).alias("published_date_raw"),
                T.head_chars(T.without_leading(text, named["title"]), length).alias("excerpt_raw"),
                named["url"].alias("article_url"),
            ),
        )

    named = F.struct(link["text"].alias("title"), U.url_join(page, link["href"]).alias("url"))
    return F.when(
        link.isNotNull() & (link["text"] != ""),
        let(named, lambda n: F.when(U.in_domain(n["url"], domain), record(n))),
    )


def _records(page: Column, bodies: Column, domain: str, length: int | None) -> Column:
    """Articles of elements: the first heading's link, or the element's where it has no heading."""

    def one(body: Column) -> Column:
        titled = F.coalesce(H.first_block(body, "h[1-4]"), body)
        return let(H.first_anchor(titled), lambda link: _article(page, link, body, domain, length))

    return F.filter(F.transform(bodies, one), lambda a: a.isNotNull())


def listed_articles(
    pages: DataFrame, domain: str, keep: list[str], fallback: bool = True, excerpt_length: int | None = None
) -> DataFrame:
    """Each listing page with the array of its ``articles``, one per article element.

    A page without any such article falls back to the elements around its
    ``h2``-``h4`` headings with a link. Both lists stay inside the page's own row,
    so no join and no shuffle is needed to know whether the first came out empty.
    ``excerpt_length`` cuts the excerpts.
    """
    page = U.url_parts(F.col("url"))
    prepared = pages.select(
        *keep, F.col("url").alias("source_listing_page"), page.alias("_page"), H.visible(F.col("html")).alias("_html")
    ).withColumn("_nodes", H.nodes(F.col("_html")))
    html, nodes = F.col("_html"), F.col("_nodes")
    found = _records(F.col("_page"), H.articles(html, nodes), domain, excerpt_length)
    if fallback:
        around = _records(F.col("_page"), H.around_linked_headings(html, nodes), domain, excerpt_length)
        found = let(found, lambda marked: F.when(F.size(marked) == 0, around).otherwise(marked))
    return prepared.select(*keep, "source_listing_page", found.alias("articles"))


def may_list_articles(url: Column, html: Column, domain: str) -> Column:
    """False only for pages in which ``listed_articles`` finds nothing: no HTML, no element of an article, no link into the domain.

    It looks for tags and link targets; no element is matched and no text is read.
    """
    shown = F.rlike(html, F.lit(r"(?i)<(?:article|h[2-4])[\s>/]")) & F.rlike(html, F.lit(r"(?i)<a[\s/]"))
    inside = let(U.url_parts(url), lambda page: F.exists(H.hrefs(H.visible(html)), lambda h: U.in_domain(U.url_join(page, h), domain)))
    return F.coalesce(F.when(shown, inside), F.lit(False))


def article_rows(
    listed: DataFrame, council: Column, keep: list[str], retrieved_at: Column | None = None
) -> DataFrame:
    """One news row per listed article; text and documents are still empty."""
    stamp = retrieval_stamp() if retrieved_at is None else retrieved_at
    rows = numbered_items(listed, F.col("articles"), "position", "_article", [*keep, "source_listing_page"])
    wide = rows.select(
        *keep,
        "position",
        council.alias("council"),
        "_article.*",
        "source_listing_page",
        F.lit("").alias("article_text_raw"),
        F.lit("").alias("linked_document_urls"),
        stamp.alias("retrieved_at_utc"),
    )
    return wide.select(*keep, "position", *NEWS_COLUMNS)


def article_listing(
    pages: DataFrame,
    council: Column,
    domain: str,
    keep: list[str],
    fallback: bool = True,
    retrieved_at: Column | None = None,
    excerpt_length: int | None = None,
) -> DataFrame:
    """News rows of listing pages: the title link, date and excerpt of each article."""
    listed = listed_articles(pages, domain, keep, fallback, excerpt_length)
    return article_rows(listed, council, keep, retrieved_at)


def article_details(
    pages: DataFrame,
    domain: str,
    order: list[str],
    extensions: tuple[str, ...] = U.DOCUMENT_EXTENSIONS,
    paths: tuple[str, ...] = U.DOCUMENT_PATHS,
    text_length: int | None = None,
) -> DataFrame:
    """Per page: main text, cut to ``text_length`` characters if given, and its linked documents."""
    content = pages.select(
        *order,
        F.col("url").alias("article_url"),
        U.url_parts(F.col("url")).alias("_page"),
        H.main_content(H.visible(F.col("html"))).alias("_content"),
    )
    links = F.transform(H.anchors(F.col("_content")), lambda a: U.url_join(F.col("_page"), a["href"]))
    documents = F.filter(
        F.array_distinct(links),
        lambda link: U.in_domain(link, domain) & U.looks_like_document(link, extensions, paths),
    )
    detailed = content.select(
        *order,
        "article_url",
        T.head_chars(H.text_of(F.col("_content")), text_length).alias("article_text_raw"),
        F.array_join(F.array_sort(documents), ";").alias("linked_document_urls"),
    )
    return first_by_long_key(detailed, "article_url", list(order)).drop(*order)


def articles_with_details(listed: DataFrame, details: DataFrame, order: list[str]) -> DataFrame:
    """Each article once, in listing order, with text and documents where collected."""
    first = first_by_key(listed, "article_url", [*order, "position"])
    return enrich(first, details, "article_url").select(*order, "position", *NEWS_COLUMNS)


def with_clash(rows: DataFrame, name: str, clash: str) -> DataFrame:
    """Add ``clash``: does another row have the same ``name``?

    Names are counted with a combined aggregate and the shared ones joined back,
    so a name that very many rows share is not gathered in one window. The rows
    are settled, so what made them runs once.
    """
    named = settle(rows)
    shared = named.groupBy(name).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > 1)
    joined = lookup_join(named, shared.select(name, F.lit(True).alias(clash)), name)
    return joined.withColumn(clash, F.coalesce(clash, F.lit(False)))


def download_manifest(
    documents: DataFrame, url: str, title: str, title_length: int | None = None, digest_length: int | None = None
) -> DataFrame:
    """Target file name per document, and whether another document has the same one."""
    target = U.safe_filename(F.col(url), F.col(title), title_length, digest_length)
    return with_clash(documents.withColumn("target_name", target), "target_name", "duplicate_target")



def with_downloads(resources: DataFrame, downloads: DataFrame) -> DataFrame:
    """Add ``downloaded_local_path`` by URL; '' where the download failed or is absent."""
    return enrich(resources, downloads.select("document_url", "downloaded_local_path"), "document_url")
