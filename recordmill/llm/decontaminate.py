"""Benchmark decontamination by size-partitioned MinHash containment search (operator 3).

A document contains a test item if it holds 80 in 100 of the item's five-word
shingles. A short item in a long document overlaps too little of it for MinHash,
so both sides are partitioned by size: items into classes of ``u / 2 < shingles
<= u`` for u = 8, 16, 32, ...; and for each class a document into windows of 2u
shingles, u apart. An item then overlaps a window by a fifth at least, and one of
48 minwise values agrees with probability 0.9999 at the threshold (an item cut in
two halves far apart is found through either). Minima of a class are minima of
pairs of the class below, so further classes cost next to nothing. An item of fewer
than eight shingles shares too little with its windows for that: it is looked up by
each of its shingles, which misses nothing.

Candidates are verified by exact containment of the item's shingles in the whole
document. Search and verification run where the document is read; nothing is
shuffled.

Items are the stated query set and go to the tasks in blocks of about
``block`` items, each block one pass over the documents whose hits are written before the
next block is collected, so what is sent or held at once is bounded by that parameter and
not by the table. Documents are removed by a 128-bit hash of their text, on which alone
it depends whether they hold an item.

Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. An
item of fewer than five words has its whole sequence as the one shingle; one without a
word is never found, nor is anything in a null text. Items repeated under one id count
once each text. Null document ids are reported as null and rows that repeat an id are
judged by their own text. Empty tables give an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordmill.llm.shared import DOCUMENT, hashed_words, hinted, kept_by, mixed, new_folder, pick, settle, shingle_hashes, slices

SHINGLE, VALUES, LEAST_CLASS = 5, 48, 8
_FOUND = "doc_id long, low long, high long, item_id long, n_item_shingles long, n_shared long"
_NAMES = [c.split()[0] for c in _FOUND.split(", ")]
_MAP_BITS = 16


@functools.lru_cache
def _factors() -> np.ndarray:
    return mixed(np.arange(1, VALUES + 1, dtype=np.uint64) * np.uint64(0xE7037ED1A0B428DB)) | np.uint64(1)


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    kept_by("decontaminate")
    return hashed_words(texts, lower=True, bare=True)


@dataclass
class Lookup:
    """Shingles of ``size`` words of short items, sorted, and beside them their items."""

    size: int
    values: np.ndarray
    items: np.ndarray

    def pairs(self, hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Pairs (document, item) that share a shingle."""
        left = np.searchsorted(self.values, hashes, "left")
        hit = np.flatnonzero(self.values[np.minimum(left, len(self.values) - 1)] == hashes)
        number = np.searchsorted(self.values, hashes[hit], "right") - left[hit]
        document = np.repeat(np.searchsorted(starts, hit, "right") - 1, number)
        inner = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
        return np.unique(np.stack([document, self.items[np.repeat(left[hit], number) + inner]], 1), axis=0)


@dataclass
class Class:
    """Items of one size: sorted minwise values and, beside them, their items."""

    width: int
    values: np.ndarray  # VALUES x items, sorted by row
    items: np.ndarray
    maps: np.ndarray  # VALUES x 2 ** _MAP_BITS: is there a value that begins with these bits?


@dataclass
class Block:
    """A bounded number of items, ready to be looked for."""

    ids: list
    sets: list[np.ndarray]
    words: np.ndarray  # of each item's shingles

    def lookups(self) -> list[Lookup]:
        """Of the items too short for a class."""
        found = []
        for size in range(1, SHINGLE + 1):
            own = [i for i in np.flatnonzero(self.words == size) if len(self.sets[i]) < LEAST_CLASS]
            if own:
                values, items = np.concatenate([self.sets[i] for i in own]), np.repeat(own, [len(self.sets[i]) for i in own])
                order = np.argsort(values, kind="stable")
                found.append(Lookup(size, values[order], items[order]))
        return found

    def classes(self) -> list[Class]:
        sizes = np.array([len(s) for s in self.sets])
        found, width = [], LEAST_CLASS
        while len(sizes) and width < 2 * sizes.max():
            own = np.flatnonzero((sizes > width // 2) & (sizes <= width) & (sizes >= LEAST_CLASS))
            if len(own):
                values = np.array([[(self.sets[i] * f >> np.uint64(32)).min() for i in own] for f in _factors()])
                order = np.argsort(values, axis=1, kind="stable")
                values = np.take_along_axis(values, order, 1)
                maps = np.zeros((VALUES, 1 << _MAP_BITS), bool)
                for k in range(VALUES):
                    maps[k, values[k] >> np.uint64(32 - _MAP_BITS)] = True
                found.append(Class(width, values, own[order], maps))
            width *= 2
        return found


def candidates(hashes: np.ndarray, starts: np.ndarray, classes: list[Class]) -> np.ndarray:
    """Pairs (document, item) with an equal minwise value in some window, as an array of rows."""
    found = []
    if not classes:
        return np.zeros((0, 2), np.int64)
    counts = np.diff(starts)
    blocks = -(-counts // LEAST_CLASS)
    owner = np.repeat(np.arange(len(counts)), blocks)
    ends = np.concatenate([[0], np.cumsum(blocks)])
    place = np.arange(len(owner)) - ends[owner]
    begins = starts[owner] + place * LEAST_CLASS
    if not len(begins):
        return np.zeros((0, 2), np.int64)
    by_width = {c.width: c for c in classes}
    for k, factor in enumerate(_factors()):
        low = np.minimum.reduceat(hashes * factor >> np.uint64(32), begins)
        own, at, width = owner, place, LEAST_CLASS
        while True:
            same = own[1:] == own[:-1]
            if width in by_width:
                c = by_width[width]
                window = low.copy()
                window[:-1][same] = np.minimum(low[:-1], low[1:])[same]
                hit = np.flatnonzero(c.maps[k][window >> np.uint64(32 - _MAP_BITS)])
                left = np.searchsorted(c.values[k], window[hit], "left")
                right = np.searchsorted(c.values[k], window[hit], "right")
                number = right - left
                if number.sum():
                    document = np.repeat(own[hit], number)
                    inner = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
                    found.append(np.stack([document, c.items[k][np.repeat(left, number) + inner]], 1))
            if width >= classes[-1].width:
                break
            even = at % 2 == 0  # blocks of twice the width: an even one with the odd one behind it
            first = np.flatnonzero(even)
            low, own, at, width = np.minimum.reduceat(low, first), own[first], at[first] // 2, width * 2
    if not found:
        return np.zeros((0, 2), np.int64)
    return np.unique(np.concatenate(found), axis=0)


def hits(texts: pa.Array, block: Block, classes: list[Class], lookups: list[Lookup], percent: int) -> list[tuple[int, int, int]]:
    """(document, item, shared shingles) of the items that the documents contain."""
    words, starts = _words(texts)
    by_size = {n: shingle_hashes(words, starts, n, whole=False) for n in {SHINGLE, *(x.size for x in lookups)}}
    pairs = [candidates(*by_size[SHINGLE], classes), *(x.pairs(*by_size[x.size]) for x in lookups)]
    found, sets = [], {}
    for document, item in np.unique(np.concatenate(pairs), axis=0).tolist():
        size, wanted = int(block.words[item]), block.sets[item]
        if (document, size) not in sets:
            sets = {k: v for k, v in sets.items() if k[0] == document}
            hashes, places = by_size[size]
            sets[document, size] = np.unique(hashes[places[document] : places[document + 1]])
        own = sets[document, size]
        place = np.minimum(np.searchsorted(own, wanted), len(own) - 1)
        shared = int((own[place] == wanted).sum())
        if 100 * shared >= percent * len(wanted):
            found.append((document, item, shared))
    return found


def _search(batches: Iterable[pa.RecordBatch], block: Block, percent: int) -> Iterator[pa.RecordBatch]:
    classes, lookups = block.classes(), block.lookups()
    for batch in slices(batches, limit=1 << 20):
        found = hits(batch.column(1), block, classes, lookups, percent)
        at = pa.array([d for d, _, _ in found], pa.int64())
        items = [[block.ids[i] for _, i, _ in found], [len(block.sets[i]) for _, i, _ in found], [n for _, _, n in found]]
        kept = [batch.column(k).take(at) for k in (0, 2, 3)]
        yield pa.RecordBatch.from_arrays([*kept, *(pa.array(x, pa.int64()) for x in items)], _NAMES)


def item_blocks(items: DataFrame, block: int) -> Iterator[Block]:
    """The items that have shingles, about ``block`` at a time."""
    texts = settle(pick(items, "item_id", "text").where("text is not null").distinct())
    number = max(1, -(-texts.count() // block))
    dealt = texts.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(number)))
    for k in range(number):
        rows = dealt.where(F.col("block") == k).select("item_id", "text").collect()
        words, starts = _words(pa.array([r.text for r in rows], pa.string()))
        counts, sets = np.diff(starts), [np.zeros(0, np.uint64)] * len(rows)
        for size in range(1, SHINGLE + 1):
            hashes, places = shingle_hashes(words, starts, size, whole=False)
            for i in np.flatnonzero(counts >= SHINGLE if size == SHINGLE else counts == size).tolist():
                sets[i] = np.unique(hashes[places[i] : places[i + 1]])
        kept = np.flatnonzero(counts)
        yield Block([rows[i].item_id for i in kept], [sets[i] for i in kept], np.minimum(counts[kept], SHINGLE))


def _found(docs: DataFrame, items: DataFrame, percent: int, block: int) -> DataFrame:
    """The hits of all blocks, each written before the next is collected."""
    spark, folder = docs.sparkSession, new_folder(docs.sparkSession)
    low, high = (F.xxhash64(F.lit(seed), "text").alias(name) for seed, name in ((1, "low"), (2, "high")))
    texts = pick(docs, "doc_id", "text").select("doc_id", "text", low, high)
    for k, own in enumerate(item_blocks(items, block)):
        texts.mapInArrow(lambda batches, own=own: _search(batches, own, percent), _FOUND).write.parquet(f"{folder}/block={k}")
    return spark.read.schema(_FOUND).parquet(folder).select(*_NAMES)


def contaminated(docs: DataFrame, items: DataFrame, percent: int = 80, block: int = 10_000) -> DataFrame:
    """``doc_id, item_id, n_item_shingles, n_shared, containment``: the items each document contains."""
    found = _found(docs, items, percent, block).drop("low", "high")
    return found.withColumn("containment", F.col("n_shared") / F.col("n_item_shingles"))


def decontaminate(docs: DataFrame, items: DataFrame, percent: int = 80, block: int = 10_000) -> DataFrame:
    """The documents that contain no item, in the columns of documents."""
    held = settle(_found(docs, items, percent, block).select("low", "high").distinct())
    kept = pick(docs, *DOCUMENT)
    low, high = (F.xxhash64(F.lit(seed), "text") for seed in (1, 2))
    left = kept.withColumns({"low": low, "high": high}).join(hinted(held), ["low", "high"], "left_anti")
    return left.select(*DOCUMENT)
