"""Dense record ids without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordmill.session import settle

_POSITION_BITS = 33


def number_rows(
    df: DataFrame, order: list[str | Column], name: str = "row_number", first: int | None = None
) -> DataFrame:
    """Add ``name``: 1, 2, 3, … over the whole table in ``order``.

    Rows must differ (see ``distinct_rows``). Those that tie in ``order`` are
    parted by their content, so a value shared by many rows does not pile up in
    one range. One range shuffle sorts the table over many tasks; the sorted
    table is settled, which fixes each row's range and its position there
    (``monotonically_increasing_id`` holds both). Rows per range are counted
    from that one column, and their running sum, a row per range, is broadcast
    as the offset. With ``first`` only the rows up to that number are read again:
    the running sum tells which ranges can hold them, which the files' statistics prune by.
    """
    tie = F.xxhash64(*[F.col(c) for c in df.columns])
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    in_order = df.repartitionByRange(*keys, tie).sortWithinPartitions(*keys, tie)
    placed = settle(
        in_order.withColumn("_place", F.monotonically_increasing_id()).select(
            *df.columns,
            F.shiftright("_place", _POSITION_BITS).alias("_range"),
            F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias("_position"),
        )
    )
    sizes = placed.groupBy("_range").count()
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_offset"))
    if first is not None:
        offsets = offsets.filter(F.col("_offset") < first)
        last = offsets.agg(F.max("_range")).first()[0]  # one number
        placed = placed.filter((F.col("_range") <= F.lit(-1 if last is None else last)) & (F.col("_position") < first))
        number = F.col("_offset") + F.col("_position") + 1
        return placed.join(F.broadcast(offsets), "_range").filter(number <= first).select(*df.columns, number.alias(name))
    return placed.join(F.broadcast(offsets), "_range").select(
        *df.columns, (F.col("_offset") + F.col("_position") + 1).alias(name)
    )


def record_id(prefix: str, number: Column, width: int = 4) -> Column:
    """``CDF0001``; numbers beyond the width grow instead of being cut."""
    return F.format_string(f"{prefix}%0{width}d", number)


def add_record_id(
    df: DataFrame, prefix: str, order: list[str | Column], width: int = 4, first: int | None = None
) -> DataFrame:
    """``record_id`` as the first column, dense in ``order``; ``first`` as in ``number_rows``."""
    numbered = number_rows(df, order, "_number", first)
    return numbered.select(record_id(prefix, F.col("_number"), width).alias("record_id"), *df.columns)
