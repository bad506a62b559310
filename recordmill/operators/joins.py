"""Lookups against another table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.operators.dedupe import first_by_key


def matching_key(df: DataFrame, key: str) -> Column:
    """The key, or for a blank one a text of the row's own that no key equals.

    Blank keys match nothing, so they need not meet in one task.
    """
    if dict(df.dtypes)[key] != "string":
        return F.col(key)
    own = F.concat(F.lit("\x00"), F.xxhash64(*[F.col(name) for name in df.columns]).cast("string"))
    return F.when(F.coalesce(F.col(key), F.lit("")) == "", own).otherwise(F.col(key))


def lookup_join(facts: DataFrame, lookup: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join ``facts`` to a ``lookup`` that has at most one row per ``key``; blank keys match nothing.

    A plain join: the facts are read once, Spark broadcasts a lookup of small
    measured size and splits skewed keys at run time.
    """
    added = [] if how in ("left_anti", "left_semi") else [name for name in lookup.columns if name != key]
    keyed = facts.withColumn("_key", matching_key(facts, key))
    other = lookup.select(F.col(key).alias("_key"), *added)
    return keyed.join(other, "_key", how).select(*facts.columns, *added)


def enrich(records: DataFrame, details: DataFrame, key: str) -> DataFrame:
    """Add the columns of ``details`` to ``records``; '' where a record has none.

    Of several details of one key the first counts, by the order of their columns.
    """
    added = [name for name in details.columns if name != key]
    once = first_by_key(details, key, added or [key])
    joined = lookup_join(records.drop(*added), once, key)
    filled = [F.coalesce(F.col(name), F.lit("")).alias(name) if name in added else F.col(name) for name in joined.columns]
    order = [name for name in records.columns if name not in added] + added
    return joined.select(*filled).select(*order)


def live_then_seed(live: DataFrame, seed: DataFrame, key: str) -> DataFrame:
    """All live rows, plus the seed rows whose key the live table does not hold.

    A blank key identifies nothing, so seed rows without a key are always kept.
    """
    known = live.filter(F.col(key) != "").select(key).distinct()
    fallback = lookup_join(seed, known, key, how="left_anti")
    return live.unionByName(fallback, allowMissingColumns=True)
