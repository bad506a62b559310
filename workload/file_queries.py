"""Round trips through files in the shared folder: raw pipe text in, published text out and back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.functions.dates import retrieval_stamp
from recordmill.functions.text import norm_ws
from recordmill.operators import columns
from recordmill.operators import documents as O
from recordmill.operators.pages import with_downloads
from recordmill.plans.publish import audit_files, audit_report, gate_folder, publish
from recordmill.session import shared_folder
from recordmill.sources import catalog, pipe_csv, sinks
from workload import registered
from workload import data as D
from workload.curation_queries import _RESOURCE_CLEAN, PLACE, RESOURCES, _numbered, raw_resources
from workload.document_queries import _TABLE_FILE, _TABLES, document_tables


def workplace(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"


def raw_folder(spark: SparkSession, folder: str) -> str:
    """Collected resources written as raw pipe text, in their order."""
    place = workplace(spark)
    sinks.write_pipe_csv(raw_resources(spark, folder).orderBy("_id").drop("_id"), f"{place}/raw/x_resource_index.csv")
    return place


_PUBLISHED = _numbered(_RESOURCE_CLEAN, "RES", "document_title_clean", "document_url_clean", "_id")


@registered(_PUBLISHED)
def published_resources(spark: SparkSession, folder: str) -> DataFrame:
    """Raw text written, published and read back: the table equals the one curated in memory."""
    place = raw_folder(spark, folder)
    publish(spark, f"{place}/raw", f"{place}/out", PLACE, prefix="x_")
    return catalog.read_catalog(spark, {"resources": f"{place}/out/x_council_resources"})["resources"]


@registered(
    f"""SELECT 'council_resources' AS dataset, count(*) AS n_rows, {1 + 8 + len(RESOURCES)} AS n_columns,
      true AS pipe_delimiter, true AS no_exported_index, true AS shape_correct,
      'document_url' AS source_field, count(*) FILTER (WHERE document_url = '') AS missing_urls FROM ({_PUBLISHED})"""
)
def published_gate(spark: SparkSession, folder: str) -> DataFrame:
    """The gate over a published folder, with the shape that its run log promises."""
    place = raw_folder(spark, folder)
    log = publish(spark, f"{place}/raw", f"{place}/out", PLACE, prefix="x_")
    form = r"WROTE council_resources \((\d+) rows x (\d+) cols\)"
    shape = log.select(*[F.regexp_extract("line", form, i).try_cast("int").alias(f"n{i}") for i in (1, 2)])
    rows, columns = shape.filter("n1 is not null").first()
    return gate_folder(spark, f"{place}/out", {"council_resources": ("document_url", rows, columns)}, prefix="x_")


@registered(
    f"""SELECT line FROM (VALUES ('No CDF source files found - skipping.'), ('News: no live file found.')) t(line)
    UNION ALL SELECT 'Council resources: loaded ' || count(*) || ' rows.' FROM orders
    UNION ALL SELECT 'Council resources: dropped ' || count(*) FILTER (document_title_clean = '' AND document_url_clean = '')
      || ' unusable row(s).' FROM ({_RESOURCE_CLEAN})
    UNION ALL SELECT 'Council resources: removed ' || (n - (SELECT count(*) FROM ({_PUBLISHED}))) || ' exact duplicate row(s).'
      FROM (SELECT count(*) FILTER (document_title_clean <> '' OR document_url_clean <> '') AS n FROM ({_RESOURCE_CLEAN}))
    UNION ALL SELECT 'WROTE council_resources (' || count(*) || ' rows x {1 + 8 + len(RESOURCES)} cols)' FROM ({_PUBLISHED})"""
)
def written_log(spark: SparkSession, folder: str) -> DataFrame:
    """The run log as written, with tables that have no raw file."""
    place = raw_folder(spark, folder)
    publish(spark, f"{place}/raw", f"{place}/out", PLACE, prefix="x_")
    return spark.read.text(f"{place}/out/x_cleaning_log").withColumnRenamed("value", "line")


@registered(
    f"""SELECT * FROM (VALUES ('x_resource_index_seed.csv', 'error', 'file_exists', 'Expected file is missing'),
        ('x_news.csv', 'error', 'file_exists', 'Expected file is missing'),
        ('x_news_seed.csv', 'error', 'file_exists', 'Expected file is missing'),
        ('x_cdf_projects_seed.csv', 'error', 'file_exists', 'Expected file is missing'),
        ('x_cdf_activities_seed.csv', 'error', 'file_exists', 'Expected file is missing'),
        ('exit', 'flag', '', '1')) t(file_name, severity, "check", details)
    UNION ALL SELECT 'x_resource_index.csv', 'pass', 'row_count', count(*) || ' data row(s) read with pipe delimiter' FROM orders
    UNION ALL SELECT 'x_resource_index.csv', 'warning', 'provenance_url',
      count(*) FILTER (document_url_clean = '') || '/' || count(*) || ' rows have no document_url' FROM ({_RESOURCE_CLEAN})
    UNION ALL SELECT 'x_resource_index.csv', 'warning', 'duplicate_url', count(*) || ' repeated document_url value(s)'
      FROM (SELECT document_url_clean FROM ({_RESOURCE_CLEAN}) WHERE document_url_clean <> '' GROUP BY 1 HAVING count(*) > 1)"""
)
def audit_report_file(spark: SparkSession, folder: str) -> DataFrame:
    """The audit of a raw folder as its report file says, and the exit flag in a row of its own."""
    place = raw_folder(spark, folder)
    flag = audit_report(spark, f"{place}/raw", f"{place}/report", prefix="x_")
    report = pipe_csv.read_pipe_csv(spark, f"{place}/report", [])
    return report.union(spark.createDataFrame([("exit", "flag", "", str(flag))], report.schema))


_MANY = 200
_MANY_FILE = f"'resource_index_' || lpad(CAST(_id % {_MANY} AS VARCHAR), 3, '0') || '.csv'"


@registered(
    f"""WITH r AS (SELECT {_MANY_FILE} AS file_name, document_url_clean AS u FROM ({_RESOURCE_CLEAN})),
      n AS (SELECT file_name, count(*) AS n, count(*) FILTER (WHERE u = '') AS blank FROM r GROUP BY 1),
      d AS (SELECT file_name, count(*) AS repeated FROM
        (SELECT file_name, u FROM r WHERE u <> '' GROUP BY 1, 2 HAVING count(*) > 1) GROUP BY 1)
    SELECT kind || '.csv' AS file_name, 'error' AS severity, 'file_exists' AS "check", 'Expected file is missing' AS details
      FROM (VALUES ('resource_index_seed'), ('news'), ('news_seed'), ('cdf_projects_seed'), ('cdf_activities_seed')) t(kind)
    UNION ALL SELECT file_name, 'pass', 'row_count', n || ' data row(s) read with pipe delimiter' FROM n
    UNION ALL SELECT file_name, 'warning', 'provenance_url', blank || '/' || n || ' rows have no document_url' FROM n WHERE blank > 0
    UNION ALL SELECT file_name, 'warning', 'duplicate_url', repeated || ' repeated document_url value(s)' FROM d"""
)
def many_files_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Two hundred files of one kind under audit, with one scan of their headers and one of their rows."""
    place = workplace(spark)
    number = F.lpad((F.col("_id") % _MANY).cast("string"), 3, "0")
    rows = raw_resources(spark, folder).withColumn("dataset", F.concat(F.lit("resource_index_"), number, F.lit(".csv")))
    sinks.write_pipe_csv(rows.repartition("dataset").drop("_id"), place, partition_by=["dataset"])
    return audit_files(spark, f"{place}/dataset=*")


_DOWNLOADED = "CASE WHEN length(url) % 4 = 0 THEN '' ELSE 'downloads/' || md5(url) END"


@registered(f"SELECT CAST(page_id AS VARCHAR) AS page_id, url AS document_url, {_DOWNLOADED} AS downloaded_local_path FROM pages")
def resaved_index(spark: SparkSession, folder: str) -> DataFrame:
    """An index is saved, joined with the outcome of its downloads, saved as the next version and read as the current one."""
    place = workplace(spark)
    pages = D.table(spark, folder, "pages").select("page_id", F.col("url").alias("document_url"))
    sinks.save_version(pages, place, "index")
    index = sinks.read_current(spark, place, "index", [])
    loaded = index.filter(F.length("document_url") % 4 != 0).select(
        "document_url", F.concat(F.lit("downloads/"), F.md5("document_url")).alias("downloaded_local_path")
    )
    sinks.save_version(with_downloads(index, loaded), place, "index", ["page_id", "document_url", "downloaded_local_path"])
    return sinks.read_current(spark, place, "index", [])


_GAPS = ["{k}", "NA", "n/a", "", "null", "{k} NA", "None", "-NaN", "nil"]


@registered(
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS id, CASE WHEN v IN ('NA', 'n/a', 'null', 'None', '-NaN') THEN '' ELSE v END AS value
    FROM (SELECT o_orderkey, {D.pick_sql("o_orderkey", _GAPS, k="o_custkey")} AS v FROM orders)"""
)
def filled_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Cells that a tabular reader takes for a missing value are read as ''."""
    place = workplace(spark)
    orders = D.table(spark, folder, "orders")
    value = D.pick(F.col("o_orderkey"), _GAPS, k=F.col("o_custkey")).alias("value")
    sinks.write_pipe_csv(orders.select(F.col("o_orderkey").alias("id"), value), place)
    return pipe_csv.read_pipe_csv(spark, place, [], missing_texts=pipe_csv.MISSING_TEXTS)


@registered(
    """SELECT lang, count(*) > 0 AS written, count(*) AS n_rows, 2 AS n_columns FROM documents GROUP BY lang
    UNION ALL SELECT 'none', false, 0, 2"""
)
def unless_empty(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of each language, and of one that has none, written unless empty and read back."""
    place = workplace(spark)
    docs = D.table(spark, folder, "documents").select("doc_id", "lang")
    found = []
    for lang in [*(r.lang for r in docs.select("lang").distinct().collect()), "none"]:
        written = sinks.write_unless_empty(docs.filter(F.col("lang") == lang), f"{place}/{lang}")
        read = pipe_csv.read_pipe_csv(spark, f"{place}/{lang}", ["doc_id", "lang"])
        count = read.agg(F.lit(lang).alias("lang"), F.lit(written).alias("written"), F.count("*").alias("n_rows"))
        found.append(count.withColumn("n_columns", F.lit(len(read.columns))))
    return columns.merge_by_name(found)


@registered(
    """SELECT 'found' AS index_name, count(*) AS n_rows, 'source_file,page,text' AS names FROM documents WHERE contains(text, 'token')
    UNION ALL SELECT 'none', 0, 'source_file,page,text'"""
)
def empty_index(spark: SparkSession, folder: str) -> DataFrame:
    """An index with rows, and one without, which keeps its columns when it is read back."""
    place = workplace(spark)
    file = F.concat(F.col("doc_id").cast("string"), F.lit(".html")).alias("source_file")
    docs = D.table(spark, folder, "documents").select(file, F.col("doc_id").alias("page"), "text")
    found = []
    for name, kept in (("found", F.contains(F.col("text"), F.lit("token"))), ("none", F.col("text").isNull())):
        sinks.write_index(docs.filter(kept), f"{place}/{name}", ["source_file", "page", "text"])
        read = spark.read.parquet(f"{place}/{name}")
        names = F.lit(",".join(read.columns)).alias("names")
        found.append(read.agg(F.lit(name).alias("index_name"), F.count("*").alias("n_rows"), names))
    return columns.merge_by_name(found)


_WIDE = f"""WITH {_TABLES}, wide AS (SELECT doc_id, table_number, cells,
        list_max(list_transform(cells, lambda r: coalesce(len(r), 0))) AS width FROM tables),
      rows AS (SELECT doc_id, table_number, width, coalesce(array_to_string(r, ''), '') AS r,
        array_to_string(r, '|') AS plain FROM (SELECT doc_id, table_number, width, unnest(cells) AS r FROM wide))"""
_BARS = "sum(greatest(width - 1, 0)) + sum(len(r) - len(replace(r, '|', '')))"


@registered(f"{_WIDE} SELECT {_TABLE_FILE} AS table_file, count(*) AS n_rows, {_BARS} AS n_bars, true AS as_indexed FROM rows GROUP BY ALL")
def table_files(spark: SparkSession, folder: str) -> DataFrame:
    """One headerless file per extracted table, read back by the file index: lines and delimiters of each."""
    place = workplace(spark)
    index = sinks.write_table_files(O.tables_by_file(document_tables(spark, folder)), place)
    bars = F.length("value") - F.length(F.replace("value", F.lit("|"), F.lit("")))
    text = sinks.read_table_files(index)
    read = text.groupBy("table_file").agg(F.count("*").alias("n_rows"), F.sum(bars).alias("n_bars"))
    same = (F.col("n_rows") == F.col("rows_written")).alias("as_indexed")
    return index.select("table_file", F.col("n_rows").alias("rows_written")).join(read, "table_file").select(*read.columns, same)


@registered(f"{_WIDE} SELECT {_TABLE_FILE} AS table_file, count(*) AS n_rows, {_BARS} AS n_bars FROM rows GROUP BY ALL")
def table_lines(spark: SparkSession, folder: str) -> DataFrame:
    """All extracted tables packed into shared files, a line per row with its table's name in front."""
    place = workplace(spark)
    sinks.write_table_lines(O.tables_by_file(document_tables(spark, folder)), place)
    text = spark.read.text(place)
    bars = F.length("value") - F.length(F.replace("value", F.lit("|"), F.lit(""))) - 2
    file = F.substring_index("value", "|", 1).alias("table_file")
    return text.groupBy(file).agg(F.count("*").alias("n_rows"), F.sum(bars).alias("n_bars"))


@registered("SELECT doc_id, true AS stamped FROM documents")
def retrieval_stamps(spark: SparkSession, folder: str) -> DataFrame:
    """Every row gets one stamp of the run in the fixed format."""
    docs = D.table(spark, folder, "documents")
    form = F.lit(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\+00:00$")
    return docs.select("doc_id", F.rlike(retrieval_stamp(), form).alias("stamped"))


@registered("SELECT CAST(doc_id AS VARCHAR) || '.html' AS source_file, doc_id AS page, " + D.norm_sql("text") + " AS text FROM documents")
def page_text_read(spark: SparkSession, folder: str) -> DataFrame:
    """Page texts written as a table and read by the page-text source."""
    place = workplace(spark)
    file = F.concat(F.col("doc_id").cast("string"), F.lit(".html")).alias("source_file")
    docs = D.table(spark, folder, "documents")
    sinks.write_index(docs.select(file, F.col("doc_id").alias("page"), "text"), place, ["source_file", "page", "text"])
    return catalog.read_page_text(spark, place).withColumn("text", norm_ws(F.col("text")))


@registered("SELECT lang || '.txt' AS file_name, true AS filled FROM documents GROUP BY lang")
def listed_files(spark: SparkSession, folder: str) -> DataFrame:
    """One file per language, found again by the file listing."""
    place = workplace(spark)
    langs = D.table(spark, folder, "documents").groupBy("lang").agg(F.count("*").cast("string").alias("n"))
    langs.coalesce(1).write.partitionBy("lang").text(place)
    files = catalog.list_files(spark, place, "part-*", recursive=True)
    name = F.concat(F.regexp_extract("path", "lang=([^/]*)/", 1), F.lit(".txt"))
    return files.select(name.alias("file_name"), (F.col("length") > 0).alias("filled"))
