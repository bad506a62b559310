"""URL parts, joining, and document tests.

``parse_url`` gives null for a path with a space, so the parts come from one
pattern that accepts any text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordmill.functions.staging import let
from recordmill.functions.text import head_chars, norm_ws, text_or_empty

_URL = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"

# File extensions and path parts that mark a document link.
DOCUMENT_EXTENSIONS = ("pdf", "doc", "docx", "xls", "xlsx", "csv", "zip")
DOCUMENT_PATHS = ("/wp-content/uploads/",)


def url_parts(url: Column) -> Column:
    """Struct of scheme, host, path, query and fragment; absent parts are ''."""
    part = lambda n: F.regexp_extract(text_or_empty(url), _URL, n)
    return F.struct(
        F.lower(part(1)).alias("scheme"),
        part(2).alias("host"),
        part(3).alias("path"),
        part(4).alias("query"),
        part(5).alias("fragment"),
    )


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(text_or_empty(url), _URL, 2))


def url_path(url: Column) -> Column:
    """Path without the ``;parameters`` of its last segment."""
    return F.regexp_replace(F.regexp_extract(text_or_empty(url), _URL, 3), r";[^/]*$", "")


def last_segment(path: Column) -> Column:
    """Name after the last slash; slashes and ``/.`` at the end do not count."""
    return F.substring_index(F.regexp_replace(path, r"(?:/\.?)+$", ""), "/", -1)


def file_name(url: Column) -> Column:
    return last_segment(url_path(url))


def extension(name: Column) -> Column:
    """Lower-case text after the last inner dot of a file name, else ''."""
    return F.lower(F.regexp_extract(name, r"(?s)^.+\.([^.]+)$", 1))


def file_type(url: Column) -> Column:
    return F.coalesce(F.nullif(extension(file_name(url)), F.lit("")), F.lit("unknown"))


def in_domain(url: Column, domain: str) -> Column:
    """Host ends with ``domain``: a plain suffix test, so a longer name also passes."""
    return F.endswith(url_host(url), F.lit(domain.lower()))


def looks_like_document(
    url: Column,
    extensions: tuple[str, ...] = DOCUMENT_EXTENSIONS,
    paths: tuple[str, ...] = DOCUMENT_PATHS,
) -> Column:
    path = F.lower(url_path(url))
    hit = extension(last_segment(path)).isin(*extensions)
    for marker in paths:
        hit = hit | F.contains(path, F.lit(marker))
    return hit


def title_or_file_name(title: Column, url: Column) -> Column:
    """Titles under three characters give way to the words of the file name."""
    words = norm_ws(F.translate(file_name(url), "-_", "  "))
    return F.when(F.length(title) < 3, words).otherwise(title)


def safe_filename(url: Column, title: Column, title_length: int | None = None, digest_length: int | None = None) -> Column:
    """Name to store a document under: its own, or one made of title and URL digest, whole or cut."""
    name = file_name(url)
    made = F.concat(head_chars(title, title_length), F.lit("-"), head_chars(F.sha1(url), digest_length), F.lit(".bin"))
    chosen = F.when(F.contains(name, F.lit(".")), name).otherwise(made)
    return F.regexp_replace(chosen, r"[^\w.-]+", "_")


def _prefixed(mark: str, value: Column) -> Column:
    return F.when(value == "", F.lit("")).otherwise(F.concat(F.lit(mark), value))


def _without_dots(path: Column) -> Column:
    segments = F.split(path, "/")
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda done, s: F.when(s == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .when(s == ".", done)
        .otherwise(F.concat(done, F.array(s))),
    )
    closing = F.when(F.rlike(path, F.lit(r"/\.{1,2}$")), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    joined = F.array_join(F.concat(kept, closing), "/")
    return F.when(F.startswith(joined, F.lit("/")), joined).otherwise(F.concat(F.lit("/"), joined))


def url_join(base: Column, href: Column) -> Column:
    """Absolute URL of ``href`` found on a page; ``base`` is ``url_parts`` of the page."""
    link = F.translate(F.regexp_replace(text_or_empty(href), r"^[\x00-\x20]+", ""), "\t\r\n", "")
    return let(F.struct(link.alias("text"), url_parts(link).alias("to")), lambda at: _joined(base, at["text"], at["to"]))


def _joined(base: Column, link: Column, to: Column) -> Column:
    scheme, host, path = to["scheme"], to["host"], to["path"]
    query, fragment = _prefixed("?", to["query"]), _prefixed("#", to["fragment"])
    origin = F.concat(
        F.when(base["scheme"] == "", F.lit("")).otherwise(F.concat(base["scheme"], F.lit(":"))),
        _prefixed("//", base["host"]),
    )
    name = F.substring_index(base["path"], "/", -1)
    folder = F.substring(base["path"], F.lit(1), F.length(base["path"]) - F.length(name))
    merged = F.when(F.startswith(path, F.lit("/")), path).otherwise(
        F.regexp_replace(F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), path), r"/{2,}", "/")
    )
    resolved = let(merged, lambda m: F.when(F.rlike(m, F.lit(r"/\.\.?(?:/|$)")), _without_dots(m)).otherwise(m))
    own_query = F.when(query == "", _prefixed("?", base["query"])).otherwise(query)
    page = F.concat(origin, base["path"], _prefixed("?", base["query"]), _prefixed("#", base["fragment"]))
    return (
        F.when(link == "", page)
        .when((scheme != "") & (scheme != base["scheme"]), link)
        .when(host != "", F.concat(base["scheme"], F.lit("://"), host, path, query, fragment))
        .when(path == "", F.concat(origin, base["path"], own_query, fragment))
        .otherwise(F.concat(origin, resolved, query, fragment))
    )
