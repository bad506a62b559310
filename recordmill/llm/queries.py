"""The registered queries of this folder, with SQL where it can say the same."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.llm import (
    byte_pairs,
    cross_alignment,
    decontaminate,
    near_duplicates,
    periodic_runs,
    quality_classifier,
    quality_rules,
    secret_scan,
    source_mix,
    substring_dedup,
    token_counts,
    token_records,
    url_filter,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def word_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op1_token_records(spark: SparkSession, folder: str) -> DataFrame:
    return token_records.token_records(table(spark, folder, "documents"), word_vocabulary())


@query
def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = substring_dedup.substring_dedup(table(spark, folder, "documents"))
    return found.drop("kept_text", "factors")


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
ORACLES["op5_substring_dedup"] = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
n AS (SELECT doc_id, k, array_to_string(w[k:k + 12], ' ') AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS k FROM d)),
f AS (SELECT x, min(doc_id) AS first FROM n GROUP BY x),
gone AS (SELECT DISTINCT doc_id, k + o AS p FROM n JOIN f USING (x), range(13) t(o) WHERE first < doc_id),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS words
  FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d) ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
), lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(lost.n, 0) AS n_removed, sha256(coalesce(kept.words, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)
"""


@query
def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    trusted = table(spark, folder, "labels").where("quality = 1")
    return quality_rules.quality_rules(table(spark, folder, "documents"), trusted)


@query
def op7_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.secret_scan(table(spark, folder, "documents"))


@query
def op9_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, folder, "documents"), size=4, percent=80)


_FOLDED = _WORDS.replace("coalesce(text, '')", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")
ORACLES["op9_near_duplicates"] = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_FOLDED} AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[k:k + 3], ' ') AS x
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS k FROM d WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (x) WHERE a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)
), near AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.a, l.b FROM reach r JOIN near l ON l.a = r.b),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM least LEFT JOIN n USING (doc_id)
"""


@query
def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, folder, "documents"), word_vocabulary())


@query
def op11_byte_pairs(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_pairs.round_trip(table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)


@query
def op12_cross_alignment(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    first, second = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return cross_alignment.cross_alignment(table(spark, folder, "documents"), first, second)


def repeating_tail(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """A tenth of the documents, by the checksum of their id, end in repeats of a stretch; a null id alters nothing."""
    if doc_id is None or not n or (value := zlib.crc32(str(doc_id).encode())) % 10:
        return None
    begin = value // 10 % n
    return begin, 1 + (n - begin) // (3 + value // 10 % 8)


@query
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs.periodic_runs(table(spark, folder, "documents"), tail=repeating_tail)
    return periodic_runs.report(found)


@query
def op3_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


_BARE = r"""regexp_extract_all(translate(coalesce({t}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[a-z0-9\x{{80}}-\x{{10FFFF}}]+')"""
ORACLES["op3_decontaminate"] = f"""
WITH i AS (SELECT row_number() OVER () AS n, item_id, w, least(len(w), 5) AS z
  FROM (SELECT DISTINCT item_id, text, {_BARE.format(t="text")} AS w FROM benchmark) WHERE len(w) > 0
), s AS (
  SELECT DISTINCT n, item_id, z, array_to_string(w[k:k + z - 1], ' ') AS x FROM (SELECT *, unnest(range(1, len(w) - z + 2)) AS k FROM i)
), d AS (
  SELECT doc_id, {_BARE.format(t="text")} AS w FROM documents
), t AS (
  SELECT DISTINCT doc_id, z, array_to_string(w[k:k + z - 1], ' ') AS x
  FROM (SELECT doc_id, w, z, unnest(range(1, len(w) - z + 2)) AS k FROM d, (SELECT DISTINCT z FROM i))
), c AS (
  SELECT n, any_value(item_id) AS item_id, count(*) AS n_item_shingles FROM s GROUP BY n
), h AS (
  SELECT t.doc_id, s.n, count(*) AS n_shared FROM t JOIN s USING (z, x) GROUP BY ALL
)
SELECT doc_id, item_id, n_item_shingles, n_shared, n_shared / n_item_shingles AS containment
FROM h JOIN c USING (n) WHERE 100 * n_shared >= 80 * n_item_shingles
"""


@query
def op2_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_classifier.score(table(spark, folder, "documents"), table(spark, folder, "labels"))


def captures(pages: DataFrame) -> DataFrame:
    """Pages with a day of fetch. The table has none, so it follows from the page number: two years, all days."""
    return pages.select(
        "page_id", "url", F.expr("date_add(DATE'2024-01-01', cast(page_id * 37 % 730 as int))").alias("fetched_on")
    )


def list_entries(found: DataFrame) -> DataFrame:
    """Dated block and allow entries derived from all captures: by host, by the domain above it, by page.

    What a month of a host's captures adds or removes follows from its smallest page number.
    """
    rows = found.select(
        "page_id",
        "fetched_on",
        url_filter.host_of(F.col("url")).alias("host"),
        url_filter.page_of(F.col("url")).alias("page"),
        F.trunc("fetched_on", "month").alias("month"),
    ).where("host <> ''")
    rows = rows.withColumn("domain", F.regexp_extract("host", r"([^.]+\.[^.]+\.[^.]+)$", 1))
    kinds = (("block", "host", "host", 3, 0), ("block", "host", "domain", 5, 1), ("allow", "host", "host", 7, 2))
    parts = None
    for name, kind, pattern, turn, shift in kinds:
        first = rows.where(F.col(pattern) != "").groupBy(F.col(pattern).alias("pattern"), "month").agg(
            F.min("page_id").alias("low")
        )
        part = first.select(
            F.lit(name).alias("list"),
            F.lit(kind).alias("kind"),
            "pattern",
            F.when((F.col("low") + shift) % turn == 0, "add").otherwise("remove").alias("action"),
            F.expr("date_add(month, cast(low % 28 as int))").alias("dated"),
        )
        parts = part if parts is None else parts.union(part)
    pages = rows.groupBy("page").agg(F.min("page_id").alias("low"), F.min("fetched_on").alias("day"))
    day = F.expr("date_add(day, cast(low % 9 as int) - 4)")
    return parts.union(pages.select(F.lit("block"), F.lit("url"), "page", F.lit("add"), day))


@query
def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    found = captures(table(spark, folder, "pages"))
    return url_filter.url_filter(found, list_entries(found))


_HOST = "coalesce(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '')"
_PATH = "regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/+$', '')"
ORACLES["op8_url_filter"] = f"""
WITH c AS (
  SELECT page_id, {_HOST} AS host, coalesce({_HOST} || {_PATH}, '') AS page,
         DATE '2024-01-01' + CAST(page_id * 37 % 730 AS INTEGER) AS fetched_on
  FROM pages
), r AS (
  SELECT *, regexp_extract(host, '([^.]+[.][^.]+[.][^.]+)$', 1) AS domain,
         CAST(date_trunc('month', fetched_on) AS DATE) AS month
  FROM c WHERE host <> ''
), f AS (
  SELECT 'block' AS list, host AS pattern, month, min(page_id) AS low, 3 AS turn, 0 AS shift FROM r GROUP BY host, month
  UNION ALL SELECT 'block', domain, month, min(page_id), 5, 1 FROM r WHERE domain <> '' GROUP BY domain, month
  UNION ALL SELECT 'allow', host, month, min(page_id), 7, 2 FROM r GROUP BY host, month
), e AS (
  SELECT list, 'host' AS kind, pattern, (low + shift) % turn = 0 AS adds, month + CAST(low % 28 AS INTEGER) AS dated
  FROM f
  UNION ALL
  SELECT 'block', 'url', page, true, min(fetched_on) + (CAST(min(page_id) % 9 AS INTEGER) - 4) FROM r GROUP BY page
), d AS (
  SELECT list, kind, pattern, dated, bool_or(adds) AS listed FROM e GROUP BY ALL
), n AS (
  SELECT *, lead(dated) OVER (PARTITION BY list, kind, pattern ORDER BY dated) AS until FROM d
), h AS (
  SELECT c.page_id, c.host, c.fetched_on, n.list
  FROM c LEFT JOIN n ON n.listed AND c.fetched_on >= n.dated AND (n.until IS NULL OR c.fetched_on < n.until)
   AND CASE n.kind WHEN 'url' THEN c.page = n.pattern
       ELSE c.host = n.pattern OR ends_with(c.host, '.' || n.pattern) END
)
SELECT page_id, host, fetched_on, count(*) FILTER (list = 'block') AS n_block,
       count(*) FILTER (list = 'allow') AS n_allow,
       count(*) FILTER (list = 'block') > 0 AND count(*) FILTER (list = 'allow') = 0 AS blocked
FROM h GROUP BY page_id, host, fetched_on
"""


@query
def op4_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return source_mix.source_mix(table(spark, folder, "documents"))
