"""The three curated tables end to end, their run log and a preview.

Projects come from customers (project rows) and suppliers (activity rows),
resources from orders, news from documents, each in the shape of a collected
table with messy cells and repeated rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.plans.curation import collected, curate, log_lines
from recordmill.plans.published import Place, news_spec, projects_spec, resources_spec
from workload import registered
from workload import data as D
from workload.text_queries import AMOUNTS, COUNCILS, FUNDS, OFFSETS, PROSE, STATUSES, WARDS, YEARS

PLACE = Place(town="Machinery", council="Machinery Town Council", constituency="Lakeside Constituency")

# Each collected table: column -> templates, in column order. The last name of
# each is the number that picks the template.
PROJECTS = {
    "council": COUNCILS, "constituency": FUNDS, "serial_number_raw": ["{k}", ""], "ward_raw": WARDS,
    "project_name_raw": ["{n}", "  {n} block  ", "", ""], "status_raw": STATUSES, "year_raw": YEARS,
    "funding_source_raw": FUNDS, "amount_zmw_raw": AMOUNTS, "source_title": ["MINUTES {k}", "", " "],
    "source_url": ["https://example.org/{k}.pdf", "", " https://example.org/minutes.pdf "],
    "extraction_note": ["table  extraction"],
}
ACTIVITIES = {
    "council": COUNCILS, "activity_type_raw": ["empowerment grants", "ROAD construction / rehab", "bursary-awards"],
    "year_raw": YEARS, "description_raw": ["{n} paid", "", "groups"], "amount_zmw_raw": AMOUNTS,
    "quantity_raw": ["{k} groups", ""], "ward_raw": WARDS, "source_type": ["Council news  article", ""],
    "source_url": ["https://example.org/?p={k}", "", "https://example.org/?p=1"],
}
RESOURCES = {
    "council": COUNCILS, "category": ["community_projects", "grants_and_loans", " publications"], "year_raw": YEARS,
    "document_title_raw": ["List {k}", "", " Approved   list {k} ", "Form"],
    "document_url": ["https://example.org/uploads/{k}.pdf", "", ""], "file_type": ["PDF", " docx ", "unknown"],
    "source_page": ["https://example.org/?page_id={k}"], "retrieved_at_utc": ["2026-09-11T15:58:03+00:00", "2026-09-11T23:30:00-02:00", ""],
}
NEWS = {
    "council": COUNCILS, "title_raw": ["{n}", "", "Title {k}"], "published_date_raw": ["September 3, 2026", "", "3 March 2025", "2024-02-29"],
    "excerpt_raw": PROSE, "article_url": ["https://example.org/?p={k}", ""], "source_listing_page": ["https://example.org/?cat=1"],
    "article_text_raw": ["{n}  12.5 million kwacha {t}", "{t}"], "linked_document_urls": ["a.pdf;b.pdf", ""],
    "retrieved_at_utc": ["2026-09-11T15:59:06+00:00"],
}


def raw_resources(spark: SparkSession, folder: str) -> DataFrame:
    """The resource table as it is collected, with its order in ``_id``."""
    orders = D.table(spark, folder, "orders").withColumn("_id", F.col("o_orderkey"))
    return _raw(orders, RESOURCES, F.col("_id"), k=F.col("o_custkey"), m=F.col("o_orderpriority"), n=F.col("o_orderstatus"))


def _raw(df: DataFrame, shape: dict[str, list[str]], key, **values) -> DataFrame:
    """Collected rows made from a driver table; ``key`` numbers them and repeats where it is coarser."""
    cells = [D.pick(key + at, templates, **values).alias(name) for at, (name, templates) in enumerate(shape.items())]
    return df.select(*cells, F.col("_id"))


def _raw_sql(table: str, shape: dict[str, list[str]], key: str, order: str, **values: str) -> str:
    cells = ", ".join(
        f"{D.norm_sql(D.pick_sql(f'{key} + {at}', templates, **values))} AS {name}"
        for at, (name, templates) in enumerate(shape.items())
    )
    return f"SELECT {cells}, {order} AS _id, 0 AS _source FROM {table}"


def project_sources(spark: SparkSession, folder: str) -> list[DataFrame]:
    customer = D.table(spark, folder, "customer").withColumn("_id", F.col("c_custkey"))
    supplier = D.table(spark, folder, "supplier").withColumn("_id", F.col("s_suppkey"))
    coarse = F.floor(F.col("_id") / 2)
    projects = _raw(customer, PROJECTS, coarse, k=coarse % 500, n=F.col("c_mktsegment"), m=F.col("c_mktsegment"), s=F.lit("F"))
    activities = _raw(supplier, ACTIVITIES, coarse, k=coarse, n=F.lit("grants"), m=F.lit("BUILDING"), s=F.lit("F"))
    order = F.col("_id")
    return [
        collected(projects, order, 0, record_kind="project").drop("_id"),
        collected(activities, order, 1, record_kind="activity").drop("_id"),
    ]


def resource_sources(spark: SparkSession, folder: str) -> list[DataFrame]:
    return [collected(raw_resources(spark, folder), F.col("_id")).drop("_id")]


def news_sources(spark: SparkSession, folder: str) -> list[DataFrame]:
    docs = D.table(spark, folder, "documents").withColumn("_id", F.col("doc_id"))
    key = F.floor(F.col("_id") / 2)
    raw = _raw(docs, NEWS, key, k=key, n=F.col("source"), m=F.col("lang"), t=F.col("text"))
    return [collected(raw, F.col("_id")).drop("_id")]


_TEMPLATES = [
    f"""SELECT *, 'project' AS record_kind FROM ({_raw_sql("customer", PROJECTS, "(c_custkey // 2)",
        "c_custkey", k="(c_custkey // 2) % 500", n="c_mktsegment", m="c_mktsegment", s="'F'")})""",
    f"""SELECT * REPLACE (1 AS _source), 'activity' AS record_kind FROM ({_raw_sql("supplier", ACTIVITIES, "(s_suppkey // 2)",
        "s_suppkey", k="(s_suppkey // 2)", n="'grants'", m="'BUILDING'", s="'F'")})""",
]
_PROJECT_COLUMNS = list(dict.fromkeys([*PROJECTS, "record_kind", *ACTIVITIES]))
_PROJECT_CLEAN = f"""SELECT *, {D.council_sql('council', 'machinery', PLACE.council)} AS council_clean,
      {D.default_sql('constituency', PLACE.constituency)} AS constituency_clean,
      {D.ward_sql('ward_raw', PLACE.town)} AS ward_clean,
      {D.first_sql('project_name_raw', 'description_raw')} AS project_name_clean,
      {D.title_sql(D.norm_sql('activity_type_raw'))} AS project_type_clean,
      {D.status_sql('status_raw')} AS status_clean, {D.year_sql('year_raw')} AS year_clean,
      {D.norm_sql('amount_zmw_raw')} AS amount_zmw_raw_kept, {D.amount_sql('amount_zmw_raw')} AS amount_zmw,
      {D.default_sql('funding_source_raw', PLACE.fund)} AS funding_source_clean,
      {D.first_sql('source_title', 'source_type')} AS source_title_clean, {D.norm_sql('source_url')} AS source_url_clean
    FROM (SELECT * FROM ({_TEMPLATES[0]}) UNION ALL BY NAME SELECT * FROM ({_TEMPLATES[1]}))"""


def _numbered(clean: str, prefix: str, name: str, url: str, order: str) -> str:
    """Usable rows, each once, numbered by first appearance. ``order`` is over ``_source`` and ``_id``."""
    return f"""SELECT '{prefix}' || CASE WHEN n < 10000 THEN lpad(CAST(n AS VARCHAR), 4, '0') ELSE CAST(n AS VARCHAR) END
        AS record_id, * EXCLUDE (n, _first)
      FROM (SELECT *, row_number() OVER (ORDER BY _first) AS n
        FROM (SELECT * EXCLUDE (_source, _id), min({order}) AS _first
          FROM ({clean}) WHERE {name} <> '' OR {url} <> '' GROUP BY ALL))"""


@registered(
    _numbered(_PROJECT_CLEAN, "CDF", "project_name_clean", "source_url_clean", "_source * 10000000000 + _id")
)
def curated_projects(spark: SparkSession, folder: str) -> DataFrame:
    return curate(project_sources(spark, folder), projects_spec(PLACE))


_RESOURCE_CLEAN = f"""SELECT *, {D.council_sql('council', 'machinery', PLACE.council)} AS council_clean,
      {D.title_sql("replace(category, '_', ' ')")} AS category_clean, {D.year_sql('year_raw')} AS year_clean,
      document_title_raw AS document_title_clean, lower(file_type) AS file_type_clean,
      document_url AS document_url_clean, source_page AS source_page_clean,
      {D.stamp_sql('retrieved_at_utc')} AS retrieved_at_utc_clean
    FROM ({_raw_sql("orders", RESOURCES, "o_orderkey", "o_orderkey", k="o_custkey", m="o_orderpriority", n="o_orderstatus")})"""


@registered(_numbered(_RESOURCE_CLEAN, "RES", "document_title_clean", "document_url_clean", "_id"))
def curated_resources(spark: SparkSession, folder: str) -> DataFrame:
    return curate(resource_sources(spark, folder), resources_spec(PLACE))


_NEWS_CLEAN = f"""SELECT *, {D.council_sql('council', 'machinery', PLACE.council)} AS council_clean,
      title_raw AS title_clean, {D.date_sql('published_date_raw')} AS published_date_clean,
      excerpt_raw AS excerpt_clean, article_text_raw AS article_text_clean,
      {D.mention_sql('article_text_raw')} AS mentioned_amount_zmw, article_url AS article_url_clean,
      source_listing_page AS source_listing_page_clean, linked_document_urls AS linked_document_urls_clean,
      {D.stamp_sql('retrieved_at_utc')} AS retrieved_at_utc_clean
    FROM ({_raw_sql("documents", NEWS, "(doc_id // 2)", "doc_id", k="(doc_id // 2)", n="source", m="lang", t="text")})"""


@registered(_numbered(_NEWS_CLEAN, "NEWS", "title_clean", "article_url_clean", "_id"))
def curated_news(spark: SparkSession, folder: str) -> DataFrame:
    return curate(news_sources(spark, folder), news_spec(PLACE))


def _log_sql(clean: str, raw: list[str], label: str, table: str, name: str, url: str, loaded: str, width: int) -> str:
    kept = ", ".join(raw)
    return f"""WITH clean AS ({clean}), usable AS (SELECT * FROM clean WHERE {name} <> '' OR {url} <> ''),
        once AS (SELECT DISTINCT {kept} FROM usable), n AS (SELECT (SELECT count(*) FROM clean) AS loaded,
          (SELECT count(*) FROM usable) AS usable, (SELECT count(*) FROM once) AS once)
      {loaded}
      UNION ALL SELECT 100, '{label}: dropped ' || (loaded - usable) || ' unusable row(s).' FROM n
      UNION ALL SELECT 101, '{label}: removed ' || (usable - once) || ' exact duplicate row(s).' FROM n
      UNION ALL SELECT 102, 'WROTE {table} (' || once || ' rows x {width} cols)' FROM n"""


_PROJECTS_LOADED = """SELECT 0 AS seq, 'CDF projects: loaded projects seed (' || count(*) || ' rows)' AS line FROM customer
      UNION ALL SELECT 1, 'CDF projects: loaded activities seed (' || count(*) || ' rows)' FROM supplier"""


@registered(
    _log_sql(_PROJECT_CLEAN, _PROJECT_COLUMNS, "CDF projects", "cdf_projects", "project_name_clean", "source_url_clean",
             _PROJECTS_LOADED, 1 + 12 + len(_PROJECT_COLUMNS))
)
def run_log_projects(spark: SparkSession, folder: str) -> DataFrame:
    projects, activities = project_sources(spark, folder)
    return log_lines({"projects seed": projects, "activities seed": activities}, projects_spec(PLACE))


@registered(
    _log_sql(_RESOURCE_CLEAN, list(RESOURCES), "Council resources", "council_resources", "document_title_clean",
             "document_url_clean", "SELECT 0 AS seq, 'Council resources: loaded ' || count(*) || ' rows.' AS line FROM orders",
             1 + 8 + len(RESOURCES))
)
def run_log_resources(spark: SparkSession, folder: str) -> DataFrame:
    return log_lines({"resources": resource_sources(spark, folder)[0]}, resources_spec(PLACE))


@registered(
    _log_sql(_NEWS_CLEAN, list(NEWS), "News", "news", "title_clean", "article_url_clean",
             "SELECT 0 AS seq, 'News: loaded ' || count(*) || ' rows.' AS line FROM documents", 1 + 10 + len(NEWS))
)
def run_log_news(spark: SparkSession, folder: str) -> DataFrame:
    return log_lines({"news": news_sources(spark, folder)[0]}, news_spec(PLACE))


PREVIEW = ["record_id", "record_kind", "ward_clean", "project_name_clean", "status_clean", "year_clean", "amount_zmw"]


@registered(
    f"""SELECT {', '.join(PREVIEW)} FROM ({_numbered(_PROJECT_CLEAN, "CDF", "project_name_clean",
      "source_url_clean", "_source * 10000000000 + _id")}) ORDER BY length(record_id), record_id LIMIT 10"""
)
def curated_preview(spark: SparkSession, folder: str) -> DataFrame:
    """The first ten records: only they are read of the numbered table, and cleaned."""
    return curate(project_sources(spark, folder), projects_spec(PLACE), first=10).select(*PREVIEW)
