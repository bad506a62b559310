"""Page texts and page tables of documents.

A document's lines are the pages of a file, so a long document is a file with
many pages. Its tables are made from the same text, inside the document's row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.functions.text import mentions_any
from recordmill.operators import documents as O
from recordmill.operators.reshape import numbered_items
from workload import registered
from workload import data as D

TERMS = (*O.EVIDENCE_TERMS, "token", "license")
_HIT = "(" + " OR ".join(f"contains(lower(text), '{term}')" for term in TERMS) + ")"
_FILES = """files AS (SELECT split_part(rtrim(url, '/'), '/', -1) AS source_file,
      max_by(url, page_id) AS source_url FROM pages
      WHERE lower(split_part(rtrim(url, '/'), '/', -1)) LIKE '_%.html' GROUP BY 1)"""
_PAGES = """page_text AS (SELECT CAST(doc_id AS VARCHAR) || '.html' AS source_file, r.i AS page, r.x AS text FROM
      (SELECT doc_id, unnest(list_transform(string_split(text, chr(10)), lambda x, i: {'i': i, 'x': x})) AS r
       FROM documents))"""


def page_text(spark: SparkSession, folder: str) -> DataFrame:
    docs = D.table(spark, folder, "documents")
    file = F.concat(F.col("doc_id").cast("string"), F.lit(".html"))
    return numbered_items(docs, F.split("text", "\n"), "page", "text", [file.alias("source_file")])


def files(spark: SparkSession, folder: str) -> DataFrame:
    return O.url_by_file(D.table(spark, folder, "pages"), order="page_id", url="url", suffix="html")


@registered(
    f"""WITH {_FILES}, {_PAGES} SELECT source_file, coalesce(source_url, '') AS source_url, page,
      {D.norm_sql('text')} AS text_raw FROM page_text LEFT JOIN files USING (source_file)"""
)
def page_text_index(spark: SparkSession, folder: str) -> DataFrame:
    return O.page_text_index(page_text(spark, folder), files(spark, folder))


@registered(
    f"""WITH {_FILES}, {_PAGES} SELECT source_file, coalesce(source_url, '') AS source_url, page,
      {D.norm_sql('text')} AS text_raw FROM page_text LEFT JOIN files USING (source_file) WHERE {_HIT}"""
)
def evidence_index(spark: SparkSession, folder: str) -> DataFrame:
    return O.evidence_index(page_text(spark, folder), files(spark, folder), TERMS)


@registered(f"SELECT doc_id, {_HIT} AS cdf_related FROM documents")
def evidence_flag(spark: SparkSession, folder: str) -> DataFrame:
    docs = D.table(spark, folder, "documents")
    return docs.select("doc_id", mentions_any(F.col("text"), TERMS).alias("cdf_related"))


@registered(
    f"""WITH {_PAGES} SELECT count(DISTINCT source_file) AS files, count(*) AS pages,
      count(*) FILTER (WHERE {_HIT}) AS evidence_pages FROM page_text"""
)
def document_totals(spark: SparkSession, folder: str) -> DataFrame:
    return O.document_totals(page_text(spark, folder), TERMS)


# Three tables per document: its lines in words, an empty one, its lines in
# sentences with one-word lines left out (a null row).
_TABLES = """tables AS (SELECT doc_id, text, 1 AS table_number,
        list_transform(string_split(text, chr(10)), lambda x: string_split(x, ' ')) AS cells FROM documents
      UNION ALL SELECT doc_id, text, 3,
        list_transform(string_split(text, chr(10)), lambda x:
          CASE WHEN contains(x, ' ') THEN string_split(x, '. ') END) FROM documents)"""
_FILE = """CAST(doc_id AS VARCHAR) || '.html'"""
_TABLE_FILE = "CAST(doc_id AS VARCHAR) || '_p' || lpad(CAST(1 + doc_id % 3 AS VARCHAR), 3, '0') || '_t0' || table_number || '.csv'"


def document_tables(spark: SparkSession, folder: str) -> DataFrame:
    docs = D.table(spark, folder, "documents")
    lines = F.split("text", "\n")
    words = F.transform(lines, lambda x: F.split(x, " "))
    sentences = F.transform(lines, lambda x: F.when(F.contains(x, F.lit(" ")), F.split(x, r"\. ")))
    nothing = F.array().cast("array<array<string>>")
    return docs.select(
        F.concat(F.col("doc_id").cast("string"), F.lit(".html")).alias("source_file"),
        (1 + F.col("doc_id") % 3).cast("int").alias("page"),
        "text",
        F.array(words, nothing, sentences).alias("tables"),
    )


@registered(
    f"""WITH {_FILES}, {_TABLES} SELECT {_FILE} AS source_file, coalesce(source_url, '') AS source_url,
      CAST(1 + doc_id % 3 AS INTEGER) AS page, table_number, {_TABLE_FILE} AS table_file, {_HIT} AS cdf_related
    FROM tables LEFT JOIN files ON files.source_file = {_FILE}"""
)
def table_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return O.table_manifest(document_tables(spark, folder), files(spark, folder), TERMS)


@registered(
    f"""WITH {_TABLES}, wide AS (SELECT doc_id, table_number, cells,
        list_max(list_transform(cells, lambda r: coalesce(len(r), 0))) AS width FROM tables),
      rows AS (SELECT doc_id, table_number, width,
        unnest(list_transform(cells, lambda r, i: {{'i': i, 'r': r}})) AS u FROM wide)
    SELECT {_FILE} AS source_file, {_TABLE_FILE} AS table_file, u.i AS row_number, width,
      len(coalesce(u.r, [])) AS filled, md5(array_to_string(coalesce(u.r, []), '|')) AS digest FROM rows"""
)
def table_cells(spark: SparkSession, folder: str) -> DataFrame:
    rows = O.table_cells(document_tables(spark, folder))
    return rows.select(
        "source_file",
        "table_file",
        "row_number",
        F.size("cells").alias("width"),
        F.size(F.filter("cells", lambda c: c.isNotNull())).alias("filled"),
        F.md5(F.array_join("cells", "|")).alias("digest"),
    )
