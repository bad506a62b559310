"""Text, vocabulary, amount and date functions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.functions import amounts, dates, text, urls, vocab
from workload import registered
from workload import data as D

GAPS = [" ", "  ", " ", "\u000b\u0085\t", "    "]


@registered(
    f"""SELECT doc_id, length(t) AS n_chars_clean, md5(t) AS digest
    FROM (SELECT doc_id, {D.norm_sql(f"replace(text, ' ', {D.pick_sql('doc_id', GAPS)})")} AS t FROM documents)"""
)
def norm_whitespace(spark: SparkSession, folder: str) -> DataFrame:
    docs = D.table(spark, folder, "documents")
    noisy = F.replace(F.col("text"), F.lit(" "), D.pick(F.col("doc_id"), GAPS))
    clean = docs.select("doc_id", text.norm_ws(noisy).alias("t"))
    return clean.select("doc_id", F.length("t").alias("n_chars_clean"), F.md5("t").alias("digest"))


STATUSES = [
    " Completed ", "IN PROGRESS", "on  going", "Completed / ready for commissioning", "", "N/A",
    "Tendering", "{s}", "Not Started", "stalled", "-", "Under   procurement", "Commissioned",
]
_STATUS_RAW = D.pick_sql("o_orderkey", STATUSES, s="o_orderstatus")


@registered(f"SELECT o_orderkey, {D.status_sql(_STATUS_RAW)} AS status_clean FROM orders")
def status_lookup(spark: SparkSession, folder: str) -> DataFrame:
    orders = D.table(spark, folder, "orders")
    raw = D.pick(F.col("o_orderkey"), STATUSES, s=F.col("o_orderstatus"))
    return orders.select("o_orderkey", vocab.status(raw).alias("status_clean"))


WARDS = ["{n}", " CENTRAL ", "rivertown", "Rivertown  central", "kasaba", "MANSA", "", "all wards", "ward {k}b/{n}", "o'{n}"]
_WARD_RAW = D.pick_sql("p_partkey", WARDS, n="p_name", k="p_partkey")


@registered(f"SELECT p_partkey, {D.ward_sql(_WARD_RAW, 'Rivertown')} AS ward_clean FROM part")
def lookup_title_fallback(spark: SparkSession, folder: str) -> DataFrame:
    part = D.table(spark, folder, "part")
    raw = D.pick(F.col("p_partkey"), WARDS, n=F.col("p_name"), k=F.col("p_partkey"))
    words = vocab.ward_words("Rivertown")
    return part.select("p_partkey", vocab.from_words_or_title(raw, words).alias("ward_clean"))


COUNCILS = ["{m}", " the {m}  council", "", " ", "Machinery\tBoard"]
_COUNCIL_RAW = D.pick_sql("c_custkey", COUNCILS, m="c_mktsegment")


@registered(
    f"""SELECT c_custkey, {D.council_sql(_COUNCIL_RAW, "machinery", "Machinery Council")} AS council_clean
    FROM customer"""
)
def canonical_contains(spark: SparkSession, folder: str) -> DataFrame:
    customer = D.table(spark, folder, "customer")
    raw = D.pick(F.col("c_custkey"), COUNCILS, m=F.col("c_mktsegment"))
    return customer.select(
        "c_custkey", text.canonical_if_mentions(raw, "Machinery", "Machinery Council").alias("council_clean")
    )


CATEGORIES = ["{p}", "{p}_and_loans", " skills__{p}", "district-wide {p}"]
_CATEGORY_RAW = D.pick_sql("o_orderkey", CATEGORIES, p="o_orderpriority")
_CATEGORY_CLEAN = D.norm_sql(_CATEGORY_RAW)


@registered(
    f"""SELECT o_orderkey, {D.title_sql(f"replace({_CATEGORY_CLEAN}, '_', ' ')")} AS category_clean,
      lower({_CATEGORY_CLEAN}) AS category_lower FROM orders"""
)
def category_title(spark: SparkSession, folder: str) -> DataFrame:
    orders = D.table(spark, folder, "orders")
    raw = D.pick(F.col("o_orderkey"), CATEGORIES, p=F.col("o_orderpriority"))
    return orders.select(
        "o_orderkey", text.category_label(raw).alias("category_clean"), text.lower_tidy(raw).alias("category_lower")
    )


@registered(
    f"""SELECT doc_id, md5({D.title_sql("regexp_replace(text, '[ßẞ]', 'ss', 'g')")}) AS digest FROM documents"""
)
def title_case_text(spark: SparkSession, folder: str) -> DataFrame:
    docs = D.table(spark, folder, "documents")
    return docs.select("doc_id", F.md5(text.title_case(F.regexp_replace("text", "[ßẞ]", "ss"))).alias("digest"))


AMOUNTS = [
    "{k}", "K{k},800,000", "{k}.8 million", "K{k}.5 million", "{k}-million-kwacha", "{k}k", "{k} k", "K{k}.8m",
    "{k} projects; 19 classrooms", "{k} thousand", "2024-{k}", "1.{k}.3", "--", "ZMW {k}", "{k} billion", "",
    ">{k}000", "{k}m", "  Zambian  Kwacha {k}", "{k}.", "-{k}", "not stated", "{k} 000", "Kwacha {k}.25",
]
_AMOUNT_RAW = D.pick_sql("o_orderkey", AMOUNTS, k="o_custkey")


@registered(
    f"""SELECT o_orderkey, {D.norm_sql("raw")} AS amount_zmw_raw_kept, {D.amount_sql("raw")} AS amount_zmw
    FROM (SELECT o_orderkey, {_AMOUNT_RAW} AS raw FROM orders)"""
)
def parse_amount(spark: SparkSession, folder: str) -> DataFrame:
    orders = D.table(spark, folder, "orders")
    raw = D.pick(F.col("o_orderkey"), AMOUNTS, k=F.col("o_custkey"))
    return orders.select(
        "o_orderkey", text.norm_ws(raw).alias("amount_zmw_raw_kept"), amounts.parse_amount(raw).alias("amount_zmw")
    )


PROSE = [
    "A {k}-million-kwacha fund was launched", "over K{k} million", "about 2,800,000 kwacha, then {k} Kwacha",
    "{k},5 BILLION kwacha for roads", "grants of {k}.25 kwacha each", "{k} - - million - kwacha", "no figure for {k}",
    "", "kwacha {k}", "{k} groups shared 7 kwacha",
]
_PROSE = D.pick_sql("c_custkey", PROSE, k="c_custkey")


@registered(f"SELECT c_custkey, {D.mention_sql('raw')} AS mentioned_amount_zmw FROM (SELECT c_custkey, {_PROSE} AS raw FROM customer)")
def mentioned_amount(spark: SparkSession, folder: str) -> DataFrame:
    customer = D.table(spark, folder, "customer")
    raw = D.pick(F.col("c_custkey"), PROSE, k=F.col("c_custkey"))
    return customer.select("c_custkey", amounts.mentioned_amount(raw).alias("mentioned_amount_zmw"))


YEARS = ["", " in 2025.", " 12025 and 2019", " FY1998/99", " é2031 2032", "_2025 20256", " 2014"]
_YEAR_TEXT = f"text || {D.pick_sql('doc_id', YEARS)}"


@registered(f"SELECT doc_id, {D.year_sql(_YEAR_TEXT)} AS year_clean FROM documents")
def first_year(spark: SparkSession, folder: str) -> DataFrame:
    docs = D.table(spark, folder, "documents")
    return docs.select(
        "doc_id", text.first_year(F.concat("text", D.pick(F.col("doc_id"), YEARS))).alias("year_clean")
    )


@registered(
    rf"""SELECT doc_id, regexp_extract({_YEAR_TEXT}, '(?:^|[^\p{{L}}\p{{N}}_])(20[0-9]{{2}})(?:$|[^\p{{L}}\p{{N}}_])', 1)
    AS year_raw FROM documents"""
)
def bounded_year(spark: SparkSession, folder: str) -> DataFrame:
    docs = D.table(spark, folder, "documents")
    return docs.select(
        "doc_id", text.bounded_year(F.concat("text", D.pick(F.col("doc_id"), YEARS))).alias("year_raw")
    )


DATES = [
    "{y}-{mm}-{dd}", "{month} {d}, {y}", "{mon} {d}, {y}", "{d} {month} {y}", "{d} {mon} {y}", "{m}/{d}/{y}",
    "{mm}-{dd}-{y}", "{y}-{mm}-{dd}T23:30:00-02:00", "", "some day", " {y}-{mm}-{dd} 10:15:00 ", "{y}-{mm}-99",
    "{d}/13/{y}",
]
_DATE_RAW = D.pick_sql(
    "o_orderkey", DATES, y="year(o_orderdate)", m="month(o_orderdate)", d="day(o_orderdate)",
    mm="strftime(o_orderdate, '%m')", dd="strftime(o_orderdate, '%d')",
    month="monthname(o_orderdate)", mon="monthname(o_orderdate)[1:3]",
)


@registered(f"SELECT o_orderkey, {D.date_sql('raw')} AS date_clean FROM (SELECT o_orderkey, {_DATE_RAW} AS raw FROM orders)")
def date_iso(spark: SparkSession, folder: str) -> DataFrame:
    orders = D.table(spark, folder, "orders")
    day = F.col("o_orderdate")
    name = F.element_at(F.array(*[F.lit(m) for m in text.MONTHS]), F.month(day))
    raw = D.pick(
        F.col("o_orderkey"), DATES, y=F.year(day), m=F.month(day), d=F.day(day),
        mm=F.format_string("%02d", F.month(day)), dd=F.format_string("%02d", F.day(day)),
        month=name, mon=F.substring(name, 1, 3),
    )
    return orders.select("o_orderkey", dates.date_iso(raw).alias("date_clean"))


OFFSETS = ["Z", "+00:00", "-02:00", "+05:30", "", "-0930", " +02"]
_STAMP_RAW = f"replace(left(CAST(ts AS VARCHAR), 19), ' ', 'T') || {D.pick_sql('event_id', OFFSETS)}"
_MINUTES = "(CASE event_id % 7 WHEN 2 THEN -120 WHEN 3 THEN 330 WHEN 5 THEN -570 WHEN 6 THEN 120 ELSE 0 END)"


@registered(
    f"""SELECT event_id, strftime(ts - to_minutes({_MINUTES}::INTEGER), '%Y-%m-%dT%H:%M:%SZ') AS retrieved_at_utc_clean
    FROM events"""
)
def timestamp_iso(spark: SparkSession, folder: str) -> DataFrame:
    events = D.table(spark, folder, "events")
    local = F.translate(F.substring(F.col("ts").cast("string"), 1, 19), " ", "T")
    raw = F.concat(local, D.pick(F.col("event_id"), OFFSETS))
    return events.select("event_id", dates.timestamp_iso(raw).alias("retrieved_at_utc_clean"))


HEADS = [
    "Bridge opened {k} Published September {d}, 2026 ", "BRIDGE OPENED {k} July  4, 2025 then May 5, 2024 ",
    "School built {k} ", "Bridge Opened {k} PUBLISHED march 3, 2021 ", "may 7, 1999 and {k} ",
]
_HEAD = D.pick_sql("doc_id", HEADS, k="doc_id % 90", d="1 + doc_id % 28")
_BODY = D.norm_sql(f"{_HEAD} || text")
_LEAD = "'Bridge opened ' || CAST(doc_id % 90 AS VARCHAR)"


@registered(
    f"""SELECT doc_id, trim(replace(regexp_extract(t,
        '(?:Published\\s+)?(?:{D.MONTH_NAMES})\\s+[0-9]{{1,2}},\\s+20[0-9]{{2}}', 0, 'i'), 'Published', ''))
        AS published_date_raw,
      md5(CASE WHEN starts_with(lower(t), lower(title)) THEN trim(t[length(title) + 1:]) ELSE t END)
        AS excerpt_digest
    FROM (SELECT doc_id, {_BODY} AS t, {_LEAD} AS title FROM documents)"""
)
def published_date_excerpt(spark: SparkSession, folder: str) -> DataFrame:
    docs = D.table(spark, folder, "documents")
    number = F.col("doc_id") % 90
    head = D.pick(F.col("doc_id"), HEADS, k=number, d=1 + F.col("doc_id") % 28)
    titled = docs.select(
        "doc_id",
        text.norm_ws(F.concat(head, F.col("text"))).alias("t"),
        F.concat(F.lit("Bridge opened "), number.cast("string")).alias("title"),
    )
    excerpt = text.without_leading(F.col("t"), F.col("title"))
    return titled.select(
        "doc_id", text.published_date(F.col("t")).alias("published_date_raw"), F.md5(excerpt).alias("excerpt_digest")
    )


FUNDS = ["{m}", "", "  ", "  {m} fund "]
_FUND = D.pick_sql("c_custkey", FUNDS, m="c_mktsegment")


@registered(f"SELECT c_custkey, {D.default_sql(_FUND, 'General fund')} AS funding_source_clean FROM customer")
def value_or_default(spark: SparkSession, folder: str) -> DataFrame:
    customer = D.table(spark, folder, "customer")
    raw = D.pick(F.col("c_custkey"), FUNDS, m=F.col("c_mktsegment"))
    return customer.select("c_custkey", text.or_default(raw, "General fund").alias("funding_source_clean"))


NAMES = ["{n}", "", "  "]
NOTES = ["note {k}", ""]
_NAME, _NOTE = D.pick_sql("c_custkey", NAMES, n="c_name"), D.pick_sql("c_custkey", NOTES, k="c_custkey")


@registered(f"SELECT c_custkey, {D.first_sql(_NAME, _NOTE)} AS project_name_clean FROM customer")
def first_non_empty(spark: SparkSession, folder: str) -> DataFrame:
    customer = D.table(spark, folder, "customer")
    key = F.col("c_custkey")
    name, note = D.pick(key, NAMES, n=F.col("c_name")), D.pick(key, NOTES, k=key)
    return customer.select("c_custkey", text.first_non_empty(name, note).alias("project_name_clean"))


@registered(
    """SELECT o_orderkey, CAST(o_custkey * 12500 AS VARCHAR) || '.0' AS amount_text,
      CAST(o_custkey // 4 AS VARCHAR) || (CASE o_custkey % 4 WHEN 0 THEN '.0' WHEN 1 THEN '.25' WHEN 2 THEN '.5'
        ELSE '.75' END) AS quarter_text FROM orders"""
)
def plain_amount_text(spark: SparkSession, folder: str) -> DataFrame:
    orders = D.table(spark, folder, "orders")
    key = F.col("o_custkey").cast("double")
    return orders.select(
        "o_orderkey",
        text.plain_number(key * 12500).alias("amount_text"),
        text.plain_number(key / 4).alias("quarter_text"),
    )


URLS = [
    "https://h.Example.com:8080/a/Report-{k}.PDF?x=1#p", "http://example.org/dir/my file {k}.docx",
    "//cdn.example.net/x/{k}", "mailto:{k}@example.org", "/rel/{k}.tar.gz;v=2", "http://example.com", "{k}.zip",
    "http://example.com/.hidden", "http://example.com/dir.{k}/", "",
]
_URL_RAW = D.pick_sql("c_custkey", URLS, k="c_custkey")


@registered(
    f"""SELECT c_custkey,
      CASE v WHEN 0 THEN 'h.example.com:8080' WHEN 1 THEN 'example.org' WHEN 2 THEN 'cdn.example.net'
        WHEN 5 THEN 'example.com' WHEN 7 THEN 'example.com' WHEN 8 THEN 'example.com' ELSE '' END AS host,
      CASE v WHEN 0 THEN 'Report-' || k || '.PDF' WHEN 1 THEN 'my file ' || k || '.docx' WHEN 2 THEN k
        WHEN 3 THEN k || '@example.org' WHEN 4 THEN k || '.tar.gz' WHEN 6 THEN k || '.zip' WHEN 7 THEN '.hidden'
        WHEN 8 THEN 'dir.' || k ELSE '' END AS name,
      CASE v WHEN 0 THEN 'pdf' WHEN 1 THEN 'docx' WHEN 3 THEN 'org' WHEN 4 THEN 'gz' WHEN 6 THEN 'zip' WHEN 8 THEN k
        ELSE 'unknown' END AS file_type,
      v IN (0, 1, 6) AS is_document,
      v IN (5, 7, 8) AS in_domain,
      CASE v WHEN 0 THEN 'Report-' || k || '.PDF' WHEN 1 THEN 'my_file_' || k || '.docx'
        WHEN 3 THEN k || '_example.org' WHEN 4 THEN k || '.tar.gz' WHEN 6 THEN k || '.zip' WHEN 7 THEN '.hidden'
        WHEN 8 THEN 'dir.' || k ELSE 'Plan_' || k || '-' || left(sha1(u), 10) || '.bin' END AS target_name
    FROM (SELECT c_custkey, c_custkey % 10 AS v, CAST(c_custkey AS VARCHAR) AS k, {_URL_RAW} AS u FROM customer)"""
)
def url_functions(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    links = D.table(spark, folder, "customer").select(key, D.pick(key, URLS, k=key).alias("u"))
    url = F.col("u")
    return links.select(
        key,
        urls.url_host(url).alias("host"),
        urls.file_name(url).alias("name"),
        urls.file_type(url).alias("file_type"),
        urls.looks_like_document(url).alias("is_document"),
        urls.in_domain(url, "example.com").alias("in_domain"),
        urls.safe_filename(url, F.concat(F.lit("Plan "), key.cast("string")), 60, 10).alias("target_name"),
    )


HREFS = ["/abs/{k}", "rel-{k}", "../up/{k}", "?q={k}", "#f{k}", "//other.example.net/{k}", "https://x.example/{k}", "", "./a/./b/../{k}/"]
_HREF_PATH = "regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1)"
_HREF_BASE = "regexp_extract(url, '^[a-z]+://[^/?#]*', 0)"
_HREF_DIR = f"regexp_replace({_HREF_PATH}, '[^/]*$', '')"


@registered(
    f"""SELECT page_id, CASE page_id % 9
        WHEN 0 THEN o || '/abs/' || k WHEN 1 THEN o || d || 'rel-' || k
        WHEN 2 THEN o || regexp_replace(d, '[^/]+/$', '') || 'up/' || k
        WHEN 3 THEN o || p || '?q=' || k
        WHEN 4 THEN regexp_replace(url, '#.*$', '') || '#f' || k
        WHEN 5 THEN regexp_extract(url, '^[a-z]+:') || '//other.example.net/' || k
        WHEN 6 THEN 'https://x.example/' || k WHEN 7 THEN url ELSE o || d || 'a/' || k || '/' END AS link_url
    FROM (SELECT page_id, url, CAST(page_id AS VARCHAR) AS k, {_HREF_BASE} AS o, {_HREF_PATH} AS p, {_HREF_DIR} AS d
          FROM pages)"""
)
def url_join_shapes(spark: SparkSession, folder: str) -> DataFrame:
    pages = D.table(spark, folder, "pages")
    href = D.pick(F.col("page_id"), HREFS, k=F.col("page_id"))
    return pages.select("page_id", urls.url_join(urls.url_parts(F.col("url")), href).alias("link_url"))


_STEM = "trim(regexp_replace(source || ' / ' || text, '[^A-Za-z0-9_-]+', '_', 'g'), '_')"


def _stem(spark: SparkSession, folder: str, length: int | None) -> DataFrame:
    docs = D.table(spark, folder, "documents")
    name = F.concat(F.col("source"), F.lit(" / "), F.col("text"))
    return docs.select("doc_id", text.safe_stem(name, length).alias("stem"))


@registered(f"SELECT doc_id, {_STEM} AS stem FROM documents")
def safe_stem(spark: SparkSession, folder: str) -> DataFrame:
    return _stem(spark, folder, None)


@registered(f"SELECT doc_id, left({_STEM}, 100) AS stem FROM documents")
def bounded_stem(spark: SparkSession, folder: str) -> DataFrame:
    """The bounded form: stems cut to a given length."""
    return _stem(spark, folder, 100)
