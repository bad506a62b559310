"""The three published tables: projects, resources and news."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from recordmill.functions.amounts import mentioned_amount, parse_amount
from recordmill.functions.dates import date_iso, timestamp_iso
from recordmill.functions.text import (
    canonical_if_mentions,
    category_label,
    first_non_empty,
    first_year,
    lower_tidy,
    norm_ws,
    or_default,
    title_case,
)
from recordmill.functions.vocab import from_words_or_title, status, ward_words
from recordmill.operators.columns import column_or_empty
from recordmill.plans.curation import CurationSpec


@dataclass(frozen=True)
class Place:
    """The council a collection is about, and the defaults of its project table."""

    town: str
    council: str
    constituency: str
    fund: str = "Constituency Development Fund (CDF)"


def projects_spec(place: Place) -> CurationSpec:
    """Project rows and activity rows in one table, told apart by ``record_kind``."""

    def derive(df: DataFrame) -> dict[str, Column]:
        raw = lambda name: column_or_empty(df, name)
        return {
            "council_clean": canonical_if_mentions(raw("council"), place.town, place.council),
            "constituency_clean": or_default(raw("constituency"), place.constituency),
            "ward_clean": from_words_or_title(raw("ward_raw"), ward_words(place.town)),
            "project_name_clean": first_non_empty(raw("project_name_raw"), raw("description_raw")),
            "project_type_clean": title_case(norm_ws(raw("activity_type_raw"))),
            "status_clean": status(raw("status_raw")),
            "year_clean": first_year(raw("year_raw")),
            "amount_zmw_raw_kept": norm_ws(raw("amount_zmw_raw")),
            "amount_zmw": parse_amount(raw("amount_zmw_raw")),
            "funding_source_clean": or_default(raw("funding_source_raw"), place.fund),
            "source_title_clean": first_non_empty(raw("source_title"), raw("source_type")),
            "source_url_clean": norm_ws(raw("source_url")),
        }

    return CurationSpec(
        label="CDF projects",
        prefix="CDF",
        table="cdf_projects",
        absent="No CDF source files found - skipping.",
        several=True,
        derive=derive,
        # Published columns, in their order.
        preferred=(
            "record_kind", "council_clean", "constituency_clean", "ward_clean", "project_name_clean",
            "project_type_clean", "status_clean", "year_clean", "amount_zmw_raw_kept", "amount_zmw",
            "funding_source_clean", "source_title_clean", "source_url_clean",
        ),
        name_column="project_name_clean",
        url_column="source_url_clean",
    )


def resources_spec(place: Place) -> CurationSpec:
    def derive(df: DataFrame) -> dict[str, Column]:
        raw = lambda name: column_or_empty(df, name)
        return {
            "council_clean": canonical_if_mentions(raw("council"), place.town, place.council),
            "category_clean": category_label(raw("category")),
            "year_clean": first_year(raw("year_raw")),
            "document_title_clean": norm_ws(raw("document_title_raw")),
            "file_type_clean": lower_tidy(raw("file_type")),
            "document_url_clean": norm_ws(raw("document_url")),
            "source_page_clean": norm_ws(raw("source_page")),
            "retrieved_at_utc_clean": timestamp_iso(raw("retrieved_at_utc")),
        }

    return CurationSpec(
        label="Council resources",
        prefix="RES",
        table="council_resources",
        absent="Council resources: no live file found.",
        derive=derive,
        # Published columns, in their order.
        preferred=(
            "council_clean", "category_clean", "year_clean", "document_title_clean", "file_type_clean",
            "document_url_clean", "source_page_clean", "retrieved_at_utc_clean",
        ),
        name_column="document_title_clean",
        url_column="document_url_clean",
    )


def news_spec(place: Place) -> CurationSpec:
    def derive(df: DataFrame) -> dict[str, Column]:
        raw = lambda name: column_or_empty(df, name)
        return {
            "council_clean": canonical_if_mentions(raw("council"), place.town, place.council),
            "title_clean": norm_ws(raw("title_raw")),
            "published_date_clean": date_iso(raw("published_date_raw")),
            "excerpt_clean": norm_ws(raw("excerpt_raw")),
            "article_text_clean": norm_ws(raw("article_text_raw")),
            "mentioned_amount_zmw": mentioned_amount(norm_ws(raw("article_text_raw"))),
            "article_url_clean": norm_ws(raw("article_url")),
            "source_listing_page_clean": norm_ws(raw("source_listing_page")),
            "linked_document_urls_clean": norm_ws(raw("linked_document_urls")),
            "retrieved_at_utc_clean": timestamp_iso(raw("retrieved_at_utc")),
        }

    return CurationSpec(
        label="News",
        prefix="NEWS",
        table="news",
        absent="News: no live file found.",
        derive=derive,
        # Published columns, in their order.
        preferred=(
            "council_clean", "title_clean", "published_date_clean", "excerpt_clean", "article_text_clean",
            "mentioned_amount_zmw", "article_url_clean", "source_listing_page_clean",
            "linked_document_urls_clean", "retrieved_at_utc_clean",
        ),
        name_column="title_clean",
        url_column="article_url_clean",
    )
