"""Indexes over page texts and page tables of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.functions.staging import let
from recordmill.functions.text import mentions_any, norm_ws, safe_stem
from recordmill.functions.urls import extension, last_segment
from recordmill.operators.dedupe import first_by_key
from recordmill.operators.joins import lookup_join
from recordmill.operators.reshape import numbered_items

# Phrases that mark a page as evidence.
EVIDENCE_TERMS = ("cdf", "constituency development fund", "community project", "ward development")


def url_by_file(resources: DataFrame, order: str, url: str = "document_url", suffix: str = "pdf") -> DataFrame:
    """Source URL per file name; of several URLs with one name the last wins.

    The name is the URL's last segment as written, query string included.
    """
    link = F.col(url)
    named = resources.select(
        last_segment(link).alias("source_file"), link.alias("source_url"), F.col(order).alias("_order")
    )
    wanted = named.filter((F.col("source_url") != "") & (extension(F.col("source_file")) == suffix))
    return first_by_key(wanted, "source_file", [F.col("_order").desc(), F.col("source_url").desc()]).drop("_order")


def with_source_url(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Add ``source_url`` by ``source_file``; '' where the file is not known."""
    found = lookup_join(rows, files, "source_file")
    return found.withColumn("source_url", F.coalesce("source_url", F.lit("")))


def page_text_index(page_text: DataFrame, files: DataFrame) -> DataFrame:
    """Normalised text per page of ``page_text(source_file, page, text)``."""
    indexed = with_source_url(page_text, files)
    return indexed.select("source_file", "source_url", "page", norm_ws(F.col("text")).alias("text_raw"))


def evidence_index(page_text: DataFrame, files: DataFrame, terms: tuple[str, ...] = EVIDENCE_TERMS) -> DataFrame:
    """Index rows of the pages whose raw text mentions one of ``terms``."""
    return page_text_index(page_text.filter(mentions_any(F.col("text"), terms)), files)


def table_width(cells: Column) -> Column:
    """Most cells in any row; a null row has none."""
    return F.coalesce(F.array_max(F.transform(cells, lambda r: F.coalesce(F.size(r), F.lit(0)))), F.lit(0))


def padded(cells: Column) -> Column:
    """Every row filled up with nulls to the width of its table."""
    nothing = F.array().cast("array<string>")

    def fill(row: Column, width: Column) -> Column:
        return let(
            F.coalesce(row, nothing),
            lambda have: F.concat(have, F.array_repeat(F.lit(None).cast("string"), width - F.size(have))),
        )

    return let(table_width(cells), lambda width: F.transform(cells, lambda row: fill(row, width)))


def table_file(source_file: Column, page: Column, table_number: Column, length: int | None = None) -> Column:
    """``<stem>_p001_t01.csv``, the stem cut to ``length`` characters if given."""
    stem = F.regexp_replace(source_file, r"(?s)^(.+)\.[^.]+$", "$1")
    return F.format_string("%s_p%03d_t%02d.csv", safe_stem(stem, length), page, table_number)


def page_tables(pages: DataFrame, tables: str = "tables") -> DataFrame:
    """One row per table of a page, numbered from 1; empty tables keep their number but no row."""
    keep = [c for c in pages.columns if c != tables]
    return numbered_items(pages, F.col(tables), "table_number", "cells", keep).filter(F.size("cells") > 0)


def table_manifest(pages: DataFrame, files: DataFrame, terms: tuple[str, ...] = EVIDENCE_TERMS) -> DataFrame:
    """One row per table of ``pages(source_file, page, text, tables)``, with its page's evidence flag."""
    found = page_tables(pages).select(
        "source_file",
        "page",
        "table_number",
        table_file(F.col("source_file"), F.col("page"), F.col("table_number")).alias("table_file"),
        mentions_any(F.col("text"), terms).alias("cdf_related"),
    )
    return with_source_url(found, files).select(
        "source_file", "source_url", "page", "table_number", "table_file", "cdf_related"
    )


def tables_by_file(pages: DataFrame) -> DataFrame:
    """``(source_file, table_file, cells)``: one row per table of ``pages(source_file, page, tables)``."""
    name = table_file(F.col("source_file"), F.col("page"), F.col("table_number"))
    return page_tables(pages).select("source_file", name.alias("table_file"), "cells")


def table_cells(pages: DataFrame) -> DataFrame:
    """One row per table row, padded to the table's width, with the file it belongs to."""
    tables = tables_by_file(pages).select("source_file", "table_file", padded(F.col("cells")).alias("_rows"))
    return numbered_items(tables, F.col("_rows"), "row_number", "cells", ["source_file", "table_file"])


def document_totals(page_text: DataFrame, terms: tuple[str, ...] = EVIDENCE_TERMS) -> DataFrame:
    """One row: files, pages and evidence pages."""
    per_file = page_text.groupBy("source_file").agg(
        F.count("*").alias("n"), F.count_if(mentions_any(F.col("text"), terms)).alias("hits")
    )
    return per_file.agg(
        F.count("*").alias("files"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("pages"),
        F.coalesce(F.sum("hits"), F.lit(0)).alias("evidence_pages"),
    )
