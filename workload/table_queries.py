"""Union, filter, duplicates, numbering, lookups and summaries over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.functions import amounts, text
from recordmill.operators import columns, dedupe, filters, joins, listing, numbering, summary
from recordmill.operators.documents import url_by_file, with_source_url
from recordmill.functions.urls import last_segment
from workload import registered
from workload import data as D


@registered(
    """SELECT 'customer' AS record_kind, c_name AS name, c_nationkey AS nationkey, c_mktsegment AS segment,
      NULL AS supplier_key FROM customer
    UNION ALL SELECT 'supplier', s_name, s_nationkey, NULL, s_suppkey FROM supplier"""
)
def union_align(spark: SparkSession, folder: str) -> DataFrame:
    customer = D.table(spark, folder, "customer").select(
        F.lit("customer").alias("record_kind"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"),
        F.col("c_mktsegment").alias("segment"),
    )
    supplier = D.table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("supplier_key"),
        F.col("s_nationkey").alias("nationkey"),
        F.col("s_name").alias("name"),
        F.lit("supplier").alias("record_kind"),
    )
    return columns.leading(columns.merge_by_name([customer, supplier]), ["record_kind", "name"])


BLANKS = ["{v}", "", "  ", "{v}"]
_TITLE = D.norm_sql(D.pick_sql("doc_id", BLANKS, v="text"))
_LINK = D.norm_sql(D.pick_sql("doc_id // 2", BLANKS, v="source"))


@registered(
    f"""SELECT doc_id, source_url_clean, md5(title_clean) AS title_digest
    FROM (SELECT doc_id, {_TITLE} AS title_clean, {_LINK} AS source_url_clean FROM documents)
    WHERE title_clean <> '' OR source_url_clean <> ''"""
)
def drop_unusable(spark: SparkSession, folder: str) -> DataFrame:
    docs = D.table(spark, folder, "documents")
    key = F.col("doc_id")
    records = docs.select(
        key,
        text.norm_ws(D.pick(key, BLANKS, v=F.col("text"))).alias("title_clean"),
        text.norm_ws(D.pick(F.floor(key / 2), BLANKS, v=F.col("source"))).alias("source_url_clean"),
    )
    usable = filters.drop_unusable(records, "title_clean", "source_url_clean")
    return usable.select("doc_id", "source_url_clean", F.md5("title_clean").alias("title_digest"))


@registered("SELECT md5(text) AS digest, lang, min(doc_id) AS first_doc FROM documents GROUP BY text, lang")
def exact_distinct(spark: SparkSession, folder: str) -> DataFrame:
    docs = D.table(spark, folder, "documents").select("text", "lang", "doc_id")
    kept = dedupe.distinct_long_rows(docs, "doc_id")
    return kept.select(F.md5("text").alias("digest"), "lang", F.col("doc_id").alias("first_doc"))


@registered("SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem")
def distinct_line_rows(spark: SparkSession, folder: str) -> DataFrame:
    return dedupe.distinct_rows(D.table(spark, folder, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag"))


@registered(
    """SELECT count(*) AS rows_in, (SELECT count(*) FROM (SELECT DISTINCT text, lang FROM documents)) AS rows_out,
      count(*) - (SELECT count(*) FROM (SELECT DISTINCT text, lang FROM documents)) AS removed FROM documents"""
)
def distinct_delta(spark: SparkSession, folder: str) -> DataFrame:
    return dedupe.distinct_counts(D.table(spark, folder, "documents").select("text", "lang"))


@registered("SELECT md5(text) AS digest, min(doc_id) AS doc_id FROM documents WHERE text <> '' GROUP BY text")
def dedupe_first_by_text(spark: SparkSession, folder: str) -> DataFrame:
    first = dedupe.first_by_long_key(D.table(spark, folder, "documents").select("doc_id", "text"), "text", ["doc_id"])
    return first.select(F.md5("text").alias("digest"), "doc_id")


@registered(
    """SELECT event_id, user_id, event_type, value FROM
      (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS r FROM events) WHERE r = 1"""
)
def dedupe_first_by_key(spark: SparkSession, folder: str) -> DataFrame:
    events = D.table(spark, folder, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return dedupe.first_by_key(events, ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@registered(
    """SELECT count(*) AS repeated FROM
      (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) > 1)"""
)
def repeated_keys(spark: SparkSession, folder: str) -> DataFrame:
    return dedupe.repeated_keys(D.table(spark, folder, "orders"), F.col("o_custkey").cast("string"))


@registered(
    """SELECT 'ORD' || CASE WHEN n < 10000 THEN lpad(CAST(n AS VARCHAR), 4, '0') ELSE CAST(n AS VARCHAR) END AS record_id,
      o_orderkey FROM
      (SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS n FROM orders)"""
)
def record_id(spark: SparkSession, folder: str) -> DataFrame:
    orders = D.table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return numbering.add_record_id(orders, "ORD", ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@registered(
    """SELECT l_orderkey, l_linenumber,
      row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS n
    FROM lineitem"""
)
def line_numbers(spark: SparkSession, folder: str) -> DataFrame:
    lines = D.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey"
    )
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return numbering.number_rows(lines, order, "n").drop("l_shipdate", "l_partkey", "l_suppkey")


_STOP = "strpos(text, '###') > 0"


@registered(
    f"""SELECT conv_id, turn, role FROM conversations c WHERE NOT EXISTS
      (SELECT 1 FROM conversations s WHERE s.conv_id = c.conv_id AND s.turn <= c.turn
        AND {_STOP.replace('text', 's.text')})"""
)
def take_while(spark: SparkSession, folder: str) -> DataFrame:
    turns = D.table(spark, folder, "conversations")
    kept = listing.take_while(turns, "conv_id", "turn", F.contains("text", F.lit("###")))
    return kept.select("conv_id", "turn", "role")


_LOG = """SELECT CAST(conv_id AS VARCHAR) AS listing, CAST(turn + 1 AS INTEGER) AS page,
      length(text) - length(replace(text, chr(10), '')) AS n_records, (conv_id + turn) % 11 = 3 AS failed FROM conversations"""


def _paged_sql(bound: str) -> str:
    return f"""SELECT listing, page, n_records FROM
      (SELECT *, min(CASE WHEN n_records = 0 OR failed THEN page END) OVER (PARTITION BY listing) AS stop
       FROM ({_LOG}) {bound}) WHERE stop IS NULL OR page < stop"""


def _paged(spark: SparkSession, folder: str, max_pages: int | None) -> DataFrame:
    turns = D.table(spark, folder, "conversations")
    log = turns.select(
        F.col("conv_id").cast("string").alias("listing"),
        (F.col("turn") + 1).cast("int").alias("page"),
        (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))).cast("long").alias("n_records"),
        ((F.col("conv_id") + F.col("turn")) % 11 == 3).alias("failed"),
    )
    return listing.listing_pages(log, max_pages).select("listing", "page", "n_records")


@registered(_paged_sql(""))
def paged_listing(spark: SparkSession, folder: str) -> DataFrame:
    return _paged(spark, folder, None)


@registered(_paged_sql("WHERE page <= 3"))
def bounded_paging(spark: SparkSession, folder: str) -> DataFrame:
    """The bounded form: listings are read up to a given page."""
    return _paged(spark, folder, 3)


_SEGMENT = "split_part(rtrim(url, '/'), '/', -1)"


@registered(
    f"""WITH named AS (SELECT page_id, url, {_SEGMENT} AS file FROM pages),
      files AS (SELECT file, max_by(url, page_id) AS source_url FROM named WHERE lower(file) LIKE '_%.html' GROUP BY file)
    SELECT page_id, file AS source_file, coalesce(source_url, '') AS source_url FROM named LEFT JOIN files USING (file)"""
)
def file_url_lookup(spark: SparkSession, folder: str) -> DataFrame:
    pages = D.table(spark, folder, "pages").select("page_id", "url")
    files = url_by_file(pages, order="page_id", url="url", suffix="html")
    return with_source_url(pages.select("page_id", last_segment(F.col("url")).alias("source_file")), files)


@registered(
    """SELECT d.doc_id, d.lang, coalesce(CAST(l.quality AS VARCHAR), '') AS quality,
      coalesce(CAST(l.toxic AS VARCHAR), '') AS toxic FROM documents d LEFT JOIN labels l USING (doc_id)"""
)
def enrich_left(spark: SparkSession, folder: str) -> DataFrame:
    docs = D.table(spark, folder, "documents").select("doc_id", "lang")
    labels = D.table(spark, folder, "labels")
    as_text = labels.select("doc_id", F.col("quality").cast("string"), F.col("toxic").cast("string"))
    return joins.enrich(docs, as_text, "doc_id")


@registered(
    """SELECT o_orderkey, n.n_name AS nation, o_orderpriority FROM orders
    JOIN customer ON c_custkey = o_custkey LEFT JOIN nation n ON n.n_nationkey = c_nationkey
    UNION ALL SELECT o_orderkey, NULL, o_orderpriority FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)"""
)
def skewed_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Orders to nations: a lookup in which each key has very many rows."""
    customer = D.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey")
    )
    orders = D.table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    placed = joins.lookup_join(orders, customer, "o_custkey")
    nations = D.table(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("nation"))
    named = joins.lookup_join(placed, nations, "n_nationkey")
    return named.select("o_orderkey", "nation", "o_orderpriority")


@registered(
    """SELECT c_custkey AS key, 'live' AS origin, CAST(c_custkey AS VARCHAR) AS url FROM customer WHERE c_custkey % 3 > 0
    UNION ALL SELECT o_orderkey, 'seed', u FROM
      (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS u FROM orders)
    WHERE u = '' OR u NOT IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_custkey % 3 > 0)"""
)
def live_then_seed(spark: SparkSession, folder: str) -> DataFrame:
    customer, orders = D.table(spark, folder, "customer"), D.table(spark, folder, "orders")
    live = customer.filter(F.col("c_custkey") % 3 > 0).select(
        F.col("c_custkey").alias("key"), F.lit("live").alias("origin"), F.col("c_custkey").cast("string").alias("url")
    )
    link = F.when(F.col("o_orderkey") % 10 == 0, "").otherwise(F.col("o_custkey").cast("string"))
    seed = orders.select(F.col("o_orderkey").alias("key"), F.lit("seed").alias("origin"), link.alias("url"))
    return joins.live_then_seed(live, seed, "url")


@registered("SELECT o_orderstatus AS value, count(*) AS n FROM orders GROUP BY 1")
def value_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return summary.value_distribution(D.table(spark, folder, "orders"), F.col("o_orderstatus"))


FIGURES = ["{k}", "K{k},000", "not stated", "{k} million", ""]
_FIGURE = D.amount_sql(D.pick_sql("o_orderkey", FIGURES, k="o_custkey"))


@registered(
    f"""SELECT count(a) AS numeric_rows, count(*) AS total_rows, sum(a) AS total,
      format('{{:,.2f}}', sum(a)) AS total_text FROM (SELECT {_FIGURE} AS a FROM orders)"""
)
def numeric_summary(spark: SparkSession, folder: str) -> DataFrame:
    raw = D.pick(F.col("o_orderkey"), FIGURES, k=F.col("o_custkey"))
    parsed = D.table(spark, folder, "orders").select(text.plain_number(amounts.parse_amount(raw)).alias("amount_zmw"))
    return summary.numeric_summary(parsed, F.col("amount_zmw"))


SUMMARISED = {
    "customer": 5, "supplier": 4, "part": 6, "orders": 6, "lineitem": 11, "events": 6, "documents": 5,
    "pages": 3, "labels": 3, "conversations": 4, "nation": 3, "region": 2, "benchmark": 2, "embeddings": 3,
}


@registered(
    " UNION ALL ".join(
        f"SELECT '{name}' AS dataset, '{name}.parquet' AS file, count(*) AS records, {n} AS columns FROM {name}"
        for name, n in SUMMARISED.items()
    )
)
def dataset_summary(spark: SparkSession, folder: str) -> DataFrame:
    return summary.dataset_summary(
        {name: (f"{name}.parquet", D.table(spark, folder, name)) for name in SUMMARISED}
    )


@registered(
    """SELECT 'Rivertown Council' AS council, (SELECT count(*) FROM documents) AS resource_records,
      (SELECT count(*) FROM pages) AS news_records, 'https://example.org/a;https://example.org/b' AS resource_pages,
      'https://example.org/news' AS news_start_url"""
)
def run_metadata(spark: SparkSession, folder: str) -> DataFrame:
    return summary.run_metadata(
        D.table(spark, folder, "documents"),
        D.table(spark, folder, "pages"),
        "Rivertown Council",
        ["https://example.org/a", "https://example.org/b"],
        "https://example.org/news",
    )
