"""The curation job shared by all published tables.

normalise → mark unusable → distinct, with counts → number → derive → order columns

Clean columns depend on the raw columns of their row only, so equal raw rows
give equal clean rows. They are derived last: both shuffles and the settled
table carry the raw columns alone.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.operators.columns import leading, merge_by_name, normalise_strings
from recordmill.operators.filters import identified
from recordmill.operators.numbering import add_record_id

ORDER = "_input_order"


@dataclass(frozen=True)
class CurationSpec:
    """What sets one published table apart from the others."""

    label: str
    prefix: str
    derive: Callable[[DataFrame], dict[str, Column]]
    preferred: tuple[str, ...]
    name_column: str
    url_column: str
    table: str
    absent: str
    several: bool = False


def _input_order(order: Column, rank: int) -> Column:
    """One number for source and place, whose smallest value a hash aggregate can keep."""
    return (F.lit(Decimal(rank * 10**35)) + order.cast("decimal(35,0)")).cast("decimal(38,0)")


def collected(df: DataFrame, order: Column, rank: int = 0, **tags: str) -> DataFrame:
    """A raw table ready for curation: tidy strings, constant tags, its input order.

    ``order`` is a whole number; ``rank`` (up to 99) puts the rows of one source
    before those of the next.
    """
    tagged = df.select("*", _input_order(order, rank).alias(ORDER))
    tidy = normalise_strings(tagged)
    return tidy.withColumns({name: F.lit(value) for name, value in tags.items()}) if tags else tidy


_SOURCE, _USABLE = "_source", "_usable"
_LAST = Decimal(10**38 - 1)


def _copies(source: int) -> str:
    return f"_copies_{source}"


def _grouped(sources: list[DataFrame], spec: CurationSpec) -> tuple[DataFrame, dict[str, Column], list[str]]:
    """Each usable row once, with the rows it stands for by source; then the clean and the raw columns.

    All unusable rows are one group of empty cells behind the others. So one shuffle of
    the raw rows gives the table and every number of its log, also where a task runs twice.
    """
    merged = merge_by_name([rows.withColumn(_SOURCE, F.lit(k)) for k, rows in enumerate(sources)])
    raw = [name for name in merged.columns if name not in (ORDER, _SOURCE)]
    clean = spec.derive(merged)
    usable = F.coalesce(identified(clean[spec.name_column], clean[spec.url_column]), F.lit(False))
    marked = merged.withColumn(_USABLE, usable)
    cells = [F.when(F.col(_USABLE), F.col(name)).alias(name) for name in raw]
    order = F.when(F.col(_USABLE), F.col(ORDER)).otherwise(F.lit(_LAST).cast("decimal(38,0)")).alias(ORDER)
    counts = [F.count_if(F.col(_SOURCE) == k).alias(_copies(k)) for k in range(len(sources))]
    groups = marked.select(*cells, _USABLE, order, _SOURCE).groupBy(*raw, _USABLE).agg(F.min(ORDER).alias(ORDER), *counts)
    return groups, clean, raw


def _published(numbered: DataFrame, clean: dict[str, Column], raw: list[str], spec: CurationSpec) -> DataFrame:
    table = numbered.filter(_USABLE).select("record_id", *raw).withColumns(clean)
    return leading(table, ["record_id", *spec.preferred])


def curate(sources: list[DataFrame], spec: CurationSpec, first: int | None = None) -> DataFrame:
    """The published table: record id, clean columns, then all raw columns.

    ``first`` gives the records up to that number alone, in no order; of the numbered
    table only the ranges that hold them are read, and only they are cleaned.
    """
    groups, clean, raw = _grouped(sources, spec)
    return _published(add_record_id(groups, spec.prefix, [ORDER], first=first), clean, raw, spec)


def curate_with_log(sources: dict[str, DataFrame], spec: CurationSpec) -> tuple[DataFrame, DataFrame]:
    """The published table of raw tables by name, and its run log, from one pass over them.

    Both are read from the same numbered table in the shared folder; the log reads its counts alone.
    """
    if not sources:
        raise ValueError("no raw table")
    groups, clean, raw = _grouped(list(sources.values()), spec)
    numbered = add_record_id(groups, spec.prefix, [ORDER])
    return _published(numbered, clean, raw, spec), _log(numbered, list(sources), spec, len({"record_id", *raw, *clean}))


def _log(groups: DataFrame, names: list[str], spec: CurationSpec, width: int) -> DataFrame:
    line = lambda seq, text: F.struct(F.lit(seq).alias("seq"), text.alias("line"))
    total = lambda value: F.coalesce(F.sum(value), F.lit(0))
    every = sum((F.col(_copies(k)) for k in range(len(names))), F.lit(0))
    counted = groups.agg(
        *[total(F.col(_copies(k))).alias(f"loaded_{k}") for k in range(len(names))],
        total(F.when(~F.col(_USABLE), every)).alias("dropped"),
        total(F.when(F.col(_USABLE), every - 1)).alias("removed"),
        F.count_if(_USABLE).alias("rows"),
    )
    loaded = []
    for k, name in enumerate(names):
        form = f"{spec.label}: loaded {name} (%d rows)" if spec.several else f"{spec.label}: loaded %d rows."
        text = line(k, F.format_string(form, f"loaded_{k}"))
        loaded.append(F.when(F.col(f"loaded_{k}") > 0, text) if spec.several else text)
    written = F.format_string(f"WROTE {spec.table} (%d rows x {width} cols)", "rows")
    lines = F.array(
        *loaded,
        line(100, F.format_string(f"{spec.label}: dropped %d unusable row(s).", "dropped")),
        line(101, F.format_string(f"{spec.label}: removed %d exact duplicate row(s).", "removed")),
        line(102, F.when(F.col("rows") == 0, f"SKIP {spec.table}: no rows.").otherwise(written)),
    )
    return counted.select(F.inline(F.filter(lines, lambda entry: entry.isNotNull())))


def log_lines(sources: dict[str, DataFrame], spec: CurationSpec) -> DataFrame:
    """Run log ``(seq, line)`` of one table: loaded by source, dropped, removed, written or skipped.

    ``sources`` are the raw tables that exist, by name. Equal raw rows are counted
    once by a combined aggregate, without numbering or cleaning the table.
    """
    if not sources:
        absent = F.struct(F.lit(0).alias("seq"), F.lit(spec.absent).alias("line"))
        return SparkSession.getActiveSession().range(1).select(F.inline(F.array(absent)))
    groups, clean, raw = _grouped(list(sources.values()), spec)
    return _log(groups, list(sources), spec, len({"record_id", *raw, *clean}))
