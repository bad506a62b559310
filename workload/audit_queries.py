"""Audit, exit flag and gates over collection-shaped views of the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.operators import audit as A
from recordmill.operators.audit import REQUIRED_COLUMNS, Collected, Published
from workload import registered
from workload import data as D


def collected(spark: SparkSession, folder: str) -> list[Collected]:
    """Six tables under audit: links, an empty seed, news, projects, a short one, and two that fail."""
    pages = D.table(spark, folder, "pages")
    docs = D.table(spark, folder, "documents")
    customer = D.table(spark, folder, "customer")
    orders = D.table(spark, folder, "orders")
    supplier = D.table(spark, folder, "supplier")
    council = F.lit("Rivertown Council").alias("council")
    links = orders.select(
        council, F.col("o_orderpriority").alias("category"), F.col("o_orderstatus").alias("document_title_raw"),
        F.when(F.col("o_orderkey") % 7 == 0, "  ").otherwise(F.col("o_custkey").cast("string")).alias("document_url"),
        F.lit("p").alias("source_page"),
    )
    news = docs.select(
        council, F.col("lang").alias("title_raw"), F.concat(F.lit(" "), F.col("text")).alias("article_url"),
        F.col("source").alias("source_listing_page"),
    )
    projects = customer.select(
        council, F.col("c_mktsegment").alias("ward_raw"), F.col("c_name").alias("project_name_raw"),
        F.when(F.col("c_custkey") % 5 > 0, F.col("c_mktsegment")).alias("source_url"),
    )
    return [
        Collected("resource_index_seed.csv", spark.createDataFrame([], links.schema), REQUIRED_COLUMNS["resource_index_seed"]),
        Collected("resource_index.csv", links, REQUIRED_COLUMNS["resource_index"]),
        Collected("news.csv", news, REQUIRED_COLUMNS["news"]),
        Collected("news_live.csv", spark.createDataFrame([], news.schema), REQUIRED_COLUMNS["news"]),
        Collected("news_seed.csv", None, REQUIRED_COLUMNS["news_seed"]),
        Collected("cdf_projects_seed.csv", projects, REQUIRED_COLUMNS["cdf_projects_seed"]),
        Collected("cdf_activities_seed.csv", supplier.select("s_name"), REQUIRED_COLUMNS["cdf_activities_seed"]),
        Collected("listing_pages.csv", pages.select("url")),
    ]


_REPEATED = "(SELECT count(*) FROM (SELECT {k} FROM {t} WHERE {w} GROUP BY 1 HAVING count(*) > 1))"
_ISSUES = f"""issues AS (
    SELECT 'resource_index_seed.csv' AS file_name, 'warning' AS severity, 'row_count' AS "check", 'No data rows found' AS details
    UNION ALL SELECT 'resource_index.csv', 'warning', 'provenance_url',
      count(*) FILTER (WHERE o_orderkey % 7 = 0) || '/' || count(*) || ' rows have no document_url' FROM orders
    UNION ALL SELECT 'resource_index.csv', 'warning', 'duplicate_url',
      {_REPEATED.format(k='o_custkey', t='orders', w='o_orderkey % 7 <> 0')} || ' repeated document_url value(s)'
    UNION ALL SELECT 'resource_index.csv', 'pass', 'row_count',
      count(*) || ' data row(s) read with pipe delimiter' FROM orders
    UNION ALL SELECT 'news.csv', 'warning', 'duplicate_url',
      {_REPEATED.format(k='text', t='documents', w="trim(text) <> ''")} || ' repeated article_url value(s)'
    UNION ALL SELECT 'news.csv', 'pass', 'row_count',
      count(*) || ' data row(s) read with pipe delimiter' FROM documents
    UNION ALL SELECT 'news_live.csv', 'error', 'row_count', 'No data rows found'
    UNION ALL SELECT 'news_seed.csv', 'error', 'file_exists', 'Expected file is missing'
    UNION ALL SELECT 'cdf_projects_seed.csv', 'warning', 'provenance_url',
      count(*) FILTER (WHERE c_custkey % 5 = 0) || '/' || count(*) || ' rows have no source_url' FROM customer
    UNION ALL SELECT 'cdf_projects_seed.csv', 'pass', 'row_count',
      count(*) || ' data row(s) read with pipe delimiter' FROM customer
    UNION ALL SELECT 'cdf_activities_seed.csv', 'error', 'required_columns',
      'Missing: activity_type_raw, council, description_raw, source_url'
    UNION ALL SELECT 'listing_pages.csv', 'pass', 'row_count',
      count(*) || ' data row(s) read with pipe delimiter' FROM pages)"""


@registered(f"WITH {_ISSUES} SELECT * FROM issues")
def raw_audit(spark: SparkSession, folder: str) -> DataFrame:
    return A.audit(spark, collected(spark, folder))


@registered(
    f"""WITH {_ISSUES} SELECT count(*) FILTER (WHERE severity = 'error') AS errors,
      count(*) FILTER (WHERE severity = 'warning') AS warnings,
      CAST(max(severity = 'error') AS INTEGER) AS exit_flag FROM issues"""
)
def audit_exit(spark: SparkSession, folder: str) -> DataFrame:
    return A.audit_exit(A.audit(spark, collected(spark, folder)))


_FILE_OF = "(CASE o_orderkey % 3 WHEN 0 THEN 'resource_index.csv' WHEN 1 THEN 'news_live.csv' ELSE 'news.csv' END)"


@registered(
    f"""WITH {_ISSUES} SELECT {_FILE_OF} AS file_name, o_orderkey FROM orders
    WHERE {_FILE_OF} NOT IN (SELECT file_name FROM issues WHERE severity = 'error')"""
)
def gate_before_curation(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_orderkey")
    file = D.pick(key, ["resource_index.csv", "news_live.csv", "news.csv"])
    records = D.table(spark, folder, "orders").select(file.alias("file_name"), key)
    return A.without_failed(records, A.audit(spark, collected(spark, folder)))


def published(spark: SparkSession, folder: str) -> list[Published]:
    orders = D.table(spark, folder, "orders").withColumn("source_url", F.col("o_custkey").cast("string"))
    supplier = D.table(spark, folder, "supplier").withColumn(
        "source_url", F.when(F.col("s_suppkey") % 10 == 0, "").otherwise(F.col("s_name"))
    )
    nation = D.table(spark, folder, "nation")
    return [
        Published("orders", orders, "source_url", 15000, 7),
        Published("supplier", supplier, "source_url", 100, 6),
        Published("nation", nation.withColumnRenamed("n_nationkey", "Unnamed: 0"), "n_name", 25, 3),
        Published("region", D.table(spark, folder, "region"), "r_name", 5, 2, header="r_regionkey,r_name"),
    ]


_GATE = """gate AS (
    SELECT 'orders' AS dataset, count(*) AS n_rows, 7 AS n_columns, true AS pipe_delimiter, true AS no_exported_index,
      count(*) = 15000 AS shape_correct, 'source_url' AS source_field, 0 AS missing_urls FROM orders
    UNION ALL SELECT 'supplier', count(*), 5, true, true, false, 'source_url',
      count(*) FILTER (WHERE s_suppkey % 10 = 0) FROM supplier
    UNION ALL SELECT 'nation', count(*), 3, true, false, count(*) = 25, 'n_name', 0 FROM nation
    UNION ALL SELECT 'region', count(*), 2, false, true, count(*) = 5, 'r_name', 0 FROM region)"""


@registered(f"WITH {_GATE} SELECT * FROM gate")
def publication_gate(spark: SparkSession, folder: str) -> DataFrame:
    return A.publication_gate(published(spark, folder))


@registered(
    f"""WITH {_GATE} SELECT bool_and(pipe_delimiter) AS pipe_delimiter, bool_and(no_exported_index) AS no_exported_index,
      bool_and(shape_correct) AS shape_correct, bool_and(missing_urls = 0) AS provenance FROM gate"""
)
def publication_passes(spark: SparkSession, folder: str) -> DataFrame:
    return A.gate_passes(A.publication_gate(published(spark, folder)))
