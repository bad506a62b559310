"""Duplicates: whole rows, and first record per key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordmill.session import settle


def distinct_rows(df: DataFrame, order: str | None = None) -> DataFrame:
    """Each different row once; nulls count as equal.

    ``order`` names a column that is not part of the row. It is kept as the
    smallest value of each group, so that first-seen order survives. Copies are
    combined on the map side: a row that fills a third of the table is shuffled
    once per task.
    """
    if order is None:
        return df.dropDuplicates()
    row = [name for name in df.columns if name != order]
    return df.groupBy(*row).agg(F.min(order).alias(order))


def distinct_counts(df: DataFrame, order: str | None = None) -> DataFrame:
    """One row: rows in, rows out, rows removed by ``distinct_rows``."""
    groups = df.groupBy(*[name for name in df.columns if name != order]).agg(F.count("*").alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_in"), F.count("*").alias("rows_out")
    ).withColumn("removed", F.col("rows_in") - F.col("rows_out"))


def _filled(df: DataFrame, keys: list[str]) -> DataFrame:
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
        if dict(df.dtypes)[key] == "string":
            df = df.filter(F.col(key) != "")
    return df


def first_by_key(df: DataFrame, keys: str | list[str], order: list[Column | str]) -> DataFrame:
    """The first row per key in ``order``; rows with a blank key are dropped.

    Spark limits each key to one row per map task before the shuffle, so a hot
    key costs one row per task there.
    """
    keys = [keys] if isinstance(keys, str) else keys
    filled = _filled(df, keys)
    first = Window.partitionBy(*keys).orderBy(*order)
    return filled.withColumn("_rank", F.row_number().over(first)).filter(F.col("_rank") == 1).drop("_rank")


#: Digests sent to every task, 16 bytes each before hashing; beyond it the join is shuffled.
SENT_DIGESTS = 1_000_000
Digest = Callable[[list[str]], list[Column]]


def digest_128(names: list[str]) -> list[Column]:
    """Two 64-bit hashes of the columns with different seeds."""
    return [F.xxhash64(F.lit(seed), *[F.col(name) for name in names]) for seed in (1, 2)]


def _parted(df: DataFrame, names: list[str], digest: Digest) -> tuple[DataFrame, DataFrame]:
    """Rows whose digest of ``names`` no other row has, and the others.

    The table is settled with its digests; only these are shuffled to count them. The
    repeated ones, if few enough, are sent to the rows, so no other column of a row
    that is alone crosses the network.
    """
    low, high = digest(names)
    kept = settle(df.withColumns({"_low": low, "_high": high}))
    repeated = settle(kept.groupBy("_low", "_high").agg(F.count("*").alias("_rows")).filter("_rows > 1").drop("_rows"))
    if repeated.count() <= SENT_DIGESTS:  # from the files' footers
        repeated = F.broadcast(repeated)
    alone, shared = (kept.join(repeated, ["_low", "_high"], how) for how in ("left_anti", "left_semi"))
    return alone.select(*df.columns), shared.select(*df.columns)


def distinct_long_rows(df: DataFrame, order: str | None = None, digest: Digest = digest_128) -> DataFrame:
    """``distinct_rows`` for long texts: rows that share a digest are compared as a whole, the others stay where they are."""
    alone, shared = _parted(df, [name for name in df.columns if name != order], digest)
    return alone.unionByName(distinct_rows(shared, order).select(*df.columns))


def first_by_long_key(df: DataFrame, key: str, order: list[Column | str], digest: Digest = digest_128) -> DataFrame:
    """``first_by_key`` for a long key, or long rows: only rows that share their key's digest are shuffled."""
    alone, shared = _parted(_filled(df, [key]), [key], digest)
    return alone.unionByName(first_by_key(shared, key, order))


def repeated_keys(df: DataFrame, key: Column) -> DataFrame:
    """One row: how many non-blank key values occur more than once."""
    counted = df.select(key.alias("k")).filter(F.col("k") != "").groupBy("k").count()
    return counted.agg(F.count_if(F.col("count") > 1).alias("repeated"))
