"""Mixing sources to target weights by Pfair scheduling (operator 4).

Time is a row of slots, a block of documents each. A source of weight w gives its
block j the release time floor(j / w) and the deadline ceil((j + 1) / w); in each
slot the released block with the earliest deadline goes next. Every prefix of the
mixture then holds w * slots blocks of the source, but for less than one block.

Weights are exact fractions, not rounded to slots of a period, so the bound holds
however long the mixture is. The earliest deadline is found slot by slot on the
driver, which holds an entry per source and writes the schedule in pieces of
``_PIECE`` slots; documents are numbered by source in one range shuffle, however
unevenly the sources are filled, and joined with the slots of their blocks.

No document is dropped: the mixture is long enough for the slowest source to pass
through once, and sources that end before begin again (``epoch``).

Null is a source of its own, a null id is numbered first, rows that repeat an
id are placed each. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Iterator, Sequence
from fractions import Fraction
from math import lcm

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordmill.llm.shared import DOCUMENT, hinted, new_folder, pick, settle

_PLACE_BITS = 33
#: Slots that the driver holds before it writes them.
_PIECE = 500_000
_SLOTS = "mix_group long, epoch long, block long, release long, deadline long, slot long"


def shares(weights: dict[str, float], period: int) -> dict[str, Fraction]:
    """Slots per source in ``period`` slots: exact, not whole."""
    exact = {s: Fraction(w) for s, w in weights.items()}
    total = sum(exact.values())
    return {s: w / total * period for s, w in exact.items()}


def schedule(weights: Sequence[Fraction], blocks: Sequence[int]) -> Iterator[tuple[int, int, int, int, int]]:
    """``source, number, release, deadline, slot`` of one block after the other, earliest deadline first.

    Ends when each source has had its number of ``blocks``; until then sources go on.
    """
    scale = lcm(*[w.denominator for w in weights])
    parts = [int(w * scale) for w in weights]
    total, left, now = sum(parts), len(parts), 0
    ready: list[tuple[int, int, int, int]] = []
    waiting = [(0, i, 0) for i in range(len(parts))]
    while left:
        while waiting and waiting[0][0] <= now:
            release, i, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * total // parts[i]), i, j, release))
        deadline, i, j, release = heapq.heappop(ready)
        if deadline <= now:
            raise AssertionError("a block missed its deadline")
        yield i, j, release, deadline, now
        heapq.heappush(waiting, ((j + 1) * total // parts[i], i, j + 1))
        left -= j + 1 == blocks[i]
        now += 1


def _slots(spark: SparkSession, weights: Sequence[Fraction], blocks: Sequence[int]) -> DataFrame:
    """The schedule as a settled table, with pass (``epoch``) and ``block`` of each block."""
    folder, rows = new_folder(spark), schedule(weights, blocks) if weights else iter(())
    while True:
        piece = np.array(list(itertools.islice(rows, _PIECE)), np.int64).reshape(-1, 5)
        group, number = piece[:, 0], piece[:, 1]
        size = np.array(blocks, np.int64)[group]
        columns = [group, number // size, number % size, piece[:, 2], piece[:, 3], piece[:, 4]]
        part = pa.table([pa.array(c) for c in columns], [x.split()[0] for x in _SLOTS.split(", ")])
        spark.createDataFrame(part, _SLOTS).write.mode("append").parquet(folder)
        if len(piece) < _PIECE:
            return spark.read.schema(_SLOTS).parquet(folder)


def numbered(docs: DataFrame, columns: Sequence[str], by: Sequence[str | Column]) -> DataFrame:
    """The rows with ``number`` 0, 1, 2, ... within each ``mix_group`` in the order ``by``."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["mix_group", *by]
    dealt = docs.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    placed = settle(
        dealt.withColumn("at", F.monotonically_increasing_id()).select(
            "mix_group", *columns, F.shiftright("at", _PLACE_BITS).alias("range"), "at"
        )
    )
    sizes = placed.groupBy("mix_group", "range").agg(F.min("at").alias("begin"), F.count(F.lit(1)).alias("rows"))
    earlier = Window.partitionBy("mix_group").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = settle(sizes.withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0))).drop("rows"))
    return placed.join(hinted(offsets), ["mix_group", "range"]).select(
        "mix_group", *columns, (F.col("before") + F.col("at") - F.col("begin")).alias("number")
    )


def _groups(docs: DataFrame, targets: dict[str, float] | None, power: float) -> list[tuple[str, int, Fraction]]:
    """Source, rows and exact weight of what is scheduled: every source, however small."""
    counts = settle(docs.groupBy("source").agg(F.count(F.lit(1)).alias("rows"))).toArrow()
    # an entry per source, not per document
    rows = dict(sorted(zip(*(counts.column(c).to_pylist() for c in ("source", "rows"))), key=lambda r: (r[0] is not None, r[0])))
    exact = {s: Fraction(repr(w)) for s, w in (targets or {}).items()}
    if any(w <= 0 for w in exact.values()):
        raise ValueError("targets are positive weights")
    others = {s: Fraction(float(n) ** power) for s, n in rows.items() if s not in exact}
    if others:
        left, total = 1 - sum(exact.values()), sum(others.values())
        if left <= 0:
            raise ValueError("targets that add up to 1 must name every source")
        exact |= {s: w * left / total for s, w in others.items()}
    return [(s, n, exact[s]) for s, n in rows.items()]


def source_mix(
    docs: DataFrame,
    targets: dict[str, float] | None = None,
    power: float = 0.9,
    block: int = 16,
    columns: Sequence[str] = ("doc_id", "source"),
) -> DataFrame:
    """``columns`` of each document and its place: ``epoch, block, release, deadline, slot, place``.

    ``targets``: weight by source; what they leave to 1 goes to the other
    sources by their number of documents to the ``power``.
    Without them a source weighs its number of documents to the ``power``. Slots
    follow each other; ``place`` orders the documents of a slot.
    """
    rows = pick(docs, *dict.fromkeys([*columns, "doc_id", "source"]))
    groups = _groups(rows.select("source"), targets, power)
    spark, kinds = docs.sparkSession, rows.select(*columns).schema
    named = [(g[0], i) for i, g in enumerate(groups)]
    named = hinted(settle(spark.createDataFrame(named, "own_name string, mix_group long")))
    grouped = rows.join(named, F.col("source").eqNullSafe(F.col("own_name"))).select(*rows.columns, "mix_group")
    tie = F.xxhash64(*[F.col(c) for c in rows.columns])
    ordered = numbered(grouped, rows.columns, ["source", "doc_id", tie])
    slots = _slots(spark, [g[2] for g in groups], [-(-g[1] // block) for g in groups])
    placed = ordered.withColumn("block", F.floor(F.col("number") / block)).withColumn("place", F.col("number") % block)
    return placed.join(hinted(slots), ["mix_group", "block"]).select(
        *[F.col(f.name) for f in kinds], "epoch", "block", "release", "deadline", "slot", "place"
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixture in the columns of documents, in the order of the schedule; repeated blocks repeat rows."""
    placed = source_mix(docs, columns=DOCUMENT, **options)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = placed.repartitionByRange(n, "slot", "place").sortWithinPartitions("slot", "place")
    return ordered.select(*DOCUMENT)
