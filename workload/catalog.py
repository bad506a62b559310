"""Imports every module that registers queries."""

from workload import (  # noqa: F401
    audit_queries,
    curation_queries,
    document_queries,
    file_queries,
    page_queries,
    table_queries,
    text_queries,
)
