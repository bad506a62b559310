"""Inputs: the driver's tables, and collection-shaped tables derived from them.

Messy cells are made from integer keys, by the same templates for Spark and for
the checking SQL. A template is text with ``{name}`` for a value of the row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _parts(template: str) -> list[str]:
    return [part for part in re.split(r"(\{\w+\})", template) if part]


def pick(key: Column, templates: list[str], **values: Column) -> Column:
    """The template at ``key mod n``, filled with the values of the row, free text last."""
    out = F.get(F.array(*[F.lit(template) for template in templates]), (key % len(templates)).cast("int"))
    for name, value in values.items():
        if any(f"{{{name}}}" in template for template in templates):
            out = F.replace(out, F.lit(f"{{{name}}}"), value.cast("string"))
    return out


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def pick_sql(key: str, templates: list[str], **values: str) -> str:
    def fill(template: str) -> str:
        parts = [f"CAST({values[p[1:-1]]} AS VARCHAR)" if p.startswith("{") else sql_text(p) for p in _parts(template)]
        return "(" + " || ".join(parts) + ")" if parts else "''"

    cases = " ".join(f"WHEN {i} THEN {fill(t)}" for i, t in enumerate(templates))
    return f"(CASE ({key}) % {len(templates)} {cases} END)"


# ---- fragments of the checking SQL -------------------------------------------------

SPACES = (
    r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
# Month names, and the currency words in the patterns below.
MONTH_NAMES = "January|February|March|April|May|June|July|August|September|October|November|December"


def norm_sql(e: str) -> str:
    return f"trim(regexp_replace(coalesce({e}, ''), '{SPACES}+', ' ', 'g'))"


def title_sql(e: str) -> str:
    runs = rf"regexp_extract_all({e}, '(\p{{L}}+|\P{{L}}+)', 1)"
    return f"array_to_string(list_transform({runs}, lambda x: upper(x[1]) || lower(x[2:])), '')"


def default_sql(e: str, default: str) -> str:
    return f"coalesce(nullif({norm_sql(e)}, ''), {sql_text(default)})"


def first_sql(*es: str) -> str:
    return "coalesce(" + ", ".join(f"nullif({norm_sql(e)}, '')" for e in es) + ", '')"


def status_sql(e: str) -> str:
    key = f"lower({norm_sql(e)})"
    return f"""CASE
      WHEN {key} IN ('completed', 'complete', 'done', 'finished') THEN 'Completed'
      WHEN {key} IN ('in progress', 'in-progress', 'ongoing', 'on going', 'under construction') THEN 'In progress'
      WHEN {key} IN ('under procurement', 'procurement', 'tendering') THEN 'Under procurement'
      WHEN {key} IN ('deferred', 'postponed', 'stalled') THEN 'Deferred'
      WHEN {key} IN ('proposed', 'planned', 'not started') THEN 'Proposed'
      ELSE 'Unknown' END"""


def ward_sql(e: str, town: str) -> str:
    key = f"lower({norm_sql(e)})"
    known = "'kapilibila', 'chifunabuli', 'kasaba', 'lubwe', 'mabumba', 'mansa', 'senama', 'chishi'"
    return f"""CASE
      WHEN {key} IN ('central', '{town.lower()}', '{town.lower()} central') THEN '{town.title()} Central'
      WHEN {key} IN ({known}) THEN upper({key}[1]) || {key}[2:]
      ELSE {title_sql(norm_sql(e))} END"""


def council_sql(e: str, token: str, canonical: str) -> str:
    v = norm_sql(e)
    return f"CASE WHEN {v} = '' OR contains(lower({v}), '{token.lower()}') THEN '{canonical}' ELSE {v} END"


def year_sql(e: str) -> str:
    return f"regexp_extract({norm_sql(e)}, '((?:19|20)[0-9]{{2}})', 1)"


def amount_sql(e: str) -> str:
    """Amount of ``e`` by a chain of sub-selects, one per rule."""
    words = r"\b(zmw|zambian\s+kwacha|kwacha|k)\b"
    cleaned = f"regexp_replace(lower({norm_sql(e)}), '{words}', ' ', 'g')"
    return f"""(SELECT CASE
        WHEN regexp_matches(b, '^[0-9]+(\\.[0-9]+)?\\s*[km]?$') THEN
          CAST(regexp_extract(b, '^[0-9.]+') AS DOUBLE)
          * (CASE right(b, 1) WHEN 'k' THEN 1000 WHEN 'm' THEN 1000000 ELSE 1 END)::DOUBLE * f
        ELSE try_cast(regexp_replace(b, '[^0-9.\\-]', '', 'g') AS DOUBLE) * f END
      FROM (SELECT f, trim(CASE WHEN f = 1e9 THEN replace(a, 'billion', ' ')
                                WHEN f = 1e6 THEN replace(a, 'million', ' ') ELSE a END) AS b
            FROM (SELECT a, (CASE WHEN contains(a, 'billion') THEN 1e9
                                  WHEN contains(a, 'million') THEN 1e6 ELSE 1e0 END)::DOUBLE AS f
                  FROM (SELECT {norm_sql(f"replace({cleaned}, ',', '')")} AS a))))"""


def mention_sql(e: str) -> str:
    # Fixed value: the pattern of a mentioned amount.
    pattern = r"([0-9]+(?:[.,][0-9]+)?)\s*[-\s]*(million|billion)?\s*[-\s]*kwacha"
    return f"""(try_cast(replace(regexp_extract({e}, '{pattern}', 1, 'i'), ',', '') AS DOUBLE)
      * (CASE lower(regexp_extract({e}, '{pattern}', 2, 'i'))
           WHEN 'million' THEN 1e6 WHEN 'billion' THEN 1e9 ELSE 1e0 END)::DOUBLE)"""


def date_sql(e: str) -> str:
    """ISO date of ``e`` by trying formats one after another."""
    v = norm_sql(e)
    forms = ["%Y-%m-%d", "%B %d, %Y", "%b %d, %Y", "%d %B %Y", "%d %b %Y", "%m/%d/%Y", "%d/%m/%Y", "%m-%d-%Y", "%d-%m-%Y"]
    tries = ", ".join(f"strftime(try_strptime({v}, '{form}'), '%Y-%m-%d')" for form in forms)
    stamped = f"""CASE WHEN regexp_matches({v}, '[+-][0-9:]+$')
      THEN strftime(try_cast({v} AS TIMESTAMPTZ) AT TIME ZONE 'UTC', '%Y-%m-%d')
      ELSE strftime(try_cast({v} AS TIMESTAMP), '%Y-%m-%d') END"""
    return f"coalesce(CASE WHEN contains({v}, ':') THEN {stamped} END, {tries}, '')"


def stamp_sql(e: str) -> str:
    v = norm_sql(e)
    return f"coalesce(strftime(try_cast({v} AS TIMESTAMPTZ) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ'), '')"


def visible_sql(html: str) -> str:
    return f"regexp_replace({html}, '(?is)<!--.*?-->|<script.*?</script>|<style.*?</style>', ' ', 'g')"


def page_text_sql(html: str) -> str:
    e = f"regexp_replace({html}, '</?[A-Za-z!][^>]*>', ' ', 'g')"
    for name, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("copy", "©"), ("middot", "·"), ("#39", "'"),
                       ("nbsp", " "), ("amp", "&")):
        e = f"replace({e}, '&{name};', {sql_text(char)})"
    return norm_sql(e)
