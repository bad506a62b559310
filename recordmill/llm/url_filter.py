"""URL filters as a temporal list join, in DataFrame operations only (operator 8).

List entries are dated: on a day a pattern is added to a list or removed from it.
Consecutive days of one pattern give the half-open intervals in which it was
listed. A capture is judged by what was listed on the day it was fetched: it is
blocked if a block entry and no allow entry matched it that day.

* Host patterns match the host and what lies below it, url patterns one page
  (host and path). Suffixes are taken of each distinct host once.
* The entries that bear on a host (or page) become its timeline: their intervals
  are laid over each other, so a day lies in at most one segment. A timeline has
  at most a row per day, whatever the number of entries and captures.
* The as-of join meets captures and segments on host and month of the fetch, so a
  host that holds a third of all captures is dealt out by month, and Spark splits
  what is still skewed.

Days outside every segment, null or unreadable urls, null fetch days and captures
without entries are not blocked. Entries with a null pattern, list or day are
void; an addition outweighs a removal of the same day. Every capture gives one
row, repeated ones too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordmill.llm.shared import pick, settle


def host_of(url: Column) -> Column:
    """Host in lower case without user and port; '' if there is none."""
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1)
    return F.coalesce(F.lower(host), F.lit(""))


def page_of(url: Column) -> Column:
    """Host and path, without scheme, query, fragment and closing slashes."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.concat(host_of(url), F.regexp_replace(path, "/+$", "")), F.lit(""))


def intervals(entries: DataFrame) -> DataFrame:
    """``list, kind, pattern, since, until``: days a pattern was listed; until is open if null."""
    keys = ["list", "kind", "pattern"]
    daily = (
        pick(entries, *keys, "action", "dated")
        .where("list is not null and pattern is not null and dated is not null")
        .groupBy(*keys, "dated")
        .agg(F.max(F.col("action") == "add").alias("listed"))
    )
    following = F.lead("dated").over(Window.partitionBy(*keys).orderBy("dated"))
    return daily.withColumn("until", following).where("listed").select(*keys, F.col("dated").alias("since"), "until")


def timeline(subjects: DataFrame, listed: DataFrame) -> DataFrame:
    """``subject, since, until, n_block, n_allow``: disjoint segments from ``subject, pattern`` pairs."""
    own = subjects.join(listed, "pattern").select("subject", "list", "since", "until")
    one = [F.when(F.col("list") == name, 1).otherwise(0).alias(name) for name in ("block", "allow")]
    begun = own.select("subject", F.col("since").alias("day"), *one)
    ended = own.where("until is not null").select("subject", F.col("until").alias("day"), *one)
    ended = ended.select("subject", "day", (-F.col("block")).alias("block"), (-F.col("allow")).alias("allow"))
    steps = begun.union(ended).groupBy("subject", "day").agg(F.sum("block").alias("block"), F.sum("allow").alias("allow"))
    ordered = Window.partitionBy("subject").orderBy("day")
    sofar = ordered.rowsBetween(Window.unboundedPreceding, 0)
    return steps.select(
        "subject",
        F.col("day").alias("since"),
        F.lead("day").over(ordered).alias("until"),
        F.sum("block").over(sofar).alias("n_block"),
        F.sum("allow").over(sofar).alias("n_allow"),
    ).where("n_block > 0 or n_allow > 0")


def _as_of(captures: DataFrame, subject: str, segments: DataFrame) -> DataFrame:
    """Segments by the months in which their subject was captured."""
    months = captures.where(f"{subject} <> ''").select(F.col(subject).alias("subject"), "month").distinct()
    inside = (F.col("since") <= F.last_day("month")) & (F.col("until").isNull() | (F.col("until") > F.col("month")))
    return settle(months.join(segments, "subject").where(inside).withColumnRenamed("month", "in_month"))


def url_filter(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """``page_id, host, fetched_on, n_block, n_allow, blocked`` of every capture.

    ``captures``: page_id, url, fetched_on (day). ``entries``: list (block or
    allow), kind (host or url), pattern, action (add or remove), dated (day).
    """
    found = pick(captures, "page_id", "url", "fetched_on").select(
        "page_id",
        "fetched_on",
        host_of(F.col("url")).alias("host"),
        page_of(F.col("url")).alias("page"),
        F.trunc("fetched_on", "month").alias("month"),
    )
    listed = settle(intervals(entries))
    labels = F.split("host", r"\.")
    suffixes = F.expr("transform(sequence(1, size(labels)), i -> array_join(slice(labels, i, size(labels)), '.'))")
    hosts = found.where("host <> ''").select("host").distinct().withColumn("labels", labels)
    by_host = hosts.select(F.col("host").alias("subject"), F.explode(suffixes).alias("pattern"))
    pages = found.where("page <> ''").select(F.col("page").alias("subject")).distinct()
    by_page = pages.withColumn("pattern", F.col("subject"))
    result = found
    for subject, pairs, kind in (("host", by_host, "host"), ("page", by_page, "url")):
        segments = settle(timeline(pairs, listed.where(F.col("kind") == kind).drop("kind")))
        at = _as_of(found, subject, segments).select(
            F.col("subject").alias(f"{kind}_subject"),
            F.col("in_month").alias(f"{kind}_month"),
            F.col("since").alias(f"{kind}_since"),
            F.col("until").alias(f"{kind}_until"),
            F.col("n_block").alias(f"{kind}_block"),
            F.col("n_allow").alias(f"{kind}_allow"),
        )
        on = (
            (F.col(subject) == F.col(f"{kind}_subject"))
            & (F.col("month") == F.col(f"{kind}_month"))
            & (F.col("fetched_on") >= F.col(f"{kind}_since"))
            & (F.col(f"{kind}_until").isNull() | (F.col("fetched_on") < F.col(f"{kind}_until")))
        )
        result = result.join(at, on, "left")
    block = F.coalesce("host_block", F.lit(0)) + F.coalesce("url_block", F.lit(0))
    allow = F.coalesce("host_allow", F.lit(0)) + F.coalesce("url_allow", F.lit(0))
    return result.select(
        "page_id",
        "host",
        "fetched_on",
        block.alias("n_block"),
        allow.alias("n_allow"),
        ((block > 0) & (allow == 0)).alias("blocked"),
    )
