"""Substring deduplication by relative Lempel-Ziv parsing (operator 5).

The reference of a document are all documents with a smaller id. It is indexed in
blocks: a seed is a run of ``SEED`` words, each window of ``window`` words is
filed under the smallest-hashed seed in it, and a block is the hash partition of
the seeds. So a window has one block that can know it, and asking that block is
asking all of them; no document meets a block that can't match.

* Runs of windows under one seed form an entry. A first aggregate per seed tells
  the seeds that several documents hold, the first document, the place there, and
  whether all entries of the seed are the same text. It is combined before its
  shuffle, so a seed that fills a third of the table costs a row per task.
* Entries of shared seeds come back to their documents with that reference place.
  An entry that equals one of an earlier document is a match as it stands. Where
  the entries of a seed differ, at the boundaries of factors, the windows of the
  first entry of each text are looked up one by one (128-bit hash, first document
  and place, the same way).
* A document joins its matches of one reference document and one offset to longest
  matches and is parsed greedily from left to right: at each position the factor
  that reaches furthest. Every word of a factor is duplicated.

Windows are judged on the input, not on what is left of it.

Null texts have no words. Rows with a null id are no reference and lose nothing.
Rows that repeat an id are judged by their own text, told apart by its 64-bit hash, and
are no reference for each other. Texts of fewer words than a window stay whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordmill.llm.shared import gather, hashed_words, hinted, mixed, pick, range_hashes, settle, shingle_hashes, slices

#: Words of a seed.
SEED = 6
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_ENTRIES = "seed long, entry long, doc_id long, text_hash long, start int, n int"
_MATCHES = "array<struct<start:int,n:int,ref:long,ref_start:int>>"
_WINDOWS = "w1 long, w2 long, doc_id long, text_hash long, start int"
_FACTORS = "array<struct<start:int,n:int,ref:long,ref_start:int>>"


def entries_of(words: np.ndarray, starts: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """seed, entry hash, text, first window, windows: one element per entry of the texts."""
    span = window - SEED + 1
    seeds, seed_starts = shingle_hashes(words, starts, SEED, whole=False)
    number = np.maximum(np.diff(starts) - window + 1, 0)
    total = int(number.sum())
    if not total:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none
    value, place = seeds, np.arange(len(seeds))
    reach = 1
    while reach < span:  # smallest seed of the next ``span`` ones, the leftmost of equals
        step = min(reach, span - reach)
        later = value[step:] < value[:-step]
        place = np.where(later, place[step:], place[:-step])
        value = np.where(later, value[step:], value[:-step])
        reach += step
    window_starts = np.concatenate([[0], np.cumsum(number)])
    text = np.repeat(np.arange(len(number)), number)
    own = np.arange(total) - window_starts[text]
    place = place[own + seed_starts[text]]
    new = np.append(True, (place[1:] != place[:-1]) | (text[1:] != text[:-1]))
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, total))
    text, begin, place = text[first], own[first], place[first]
    lead = place - seed_starts[text] - begin
    content = range_hashes(words, starts[text] + begin, n + window - 1)
    return seeds[place], mixed(content + lead.astype(np.uint64)), text, begin, n


def _entries(batches: Iterable[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, limit=2 << 20):
        words, starts = hashed_words(batch.column(1))
        seed, entry, text, begin, n = entries_of(words, starts, window)
        columns = [
            pa.array(seed.view(np.int64)),
            pa.array(entry.view(np.int64)),
            batch.column(0).take(pa.array(text)),
            batch.column(2).take(pa.array(text)),
            pa.array(begin.astype(np.int32)),
            pa.array(n.astype(np.int32)),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["seed", "entry", "doc_id", "text_hash", "start", "n"])


def _windows(batches: Iterable[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Every window of the open entries by itself."""
    for batch in slices(batches, limit=2 << 20):
        words, starts = hashed_words(batch.column(1))
        lists = batch.column(3)
        counts = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten()
        begin, n = (flat.field(name).to_numpy().astype(np.int64) for name in ("start", "n"))
        text = np.repeat(np.arange(batch.num_rows), counts)
        every = gather(np.arange(len(words) + 1), starts[text] + begin, n)
        text = np.repeat(text, n)
        inside = every + window <= starts[text + 1]
        every, text = every[inside], text[inside]
        lengths = np.full(len(every), window)
        one = range_hashes(words, every, lengths)
        two = range_hashes(mixed(words ^ np.uint64(0xA0761D6478BD642F)), every, lengths)
        columns = [
            pa.array(one.view(np.int64)),
            pa.array(two.view(np.int64)),
            batch.column(0).take(pa.array(text)),
            batch.column(2).take(pa.array(text)),
            pa.array((every - starts[text]).astype(np.int32)),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["w1", "w2", "doc_id", "text_hash", "start"])


def _firsts(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys of more than one document, their first document and place in it."""
    more = [F.min("entry").alias("low"), F.max("entry").alias("high")] if "entry" in rows.columns else []
    found = rows.groupBy(*keys).agg(
        F.min("doc_id").alias("ref"),
        F.max("doc_id").alias("last"),
        F.expr("min_by(start, doc_id)").alias("ref_start"),
        *more,
    )
    open_ = F.col("low") != F.col("high") if more else F.lit(False)
    return settle(found.where("ref < last").select(*keys, "ref", "ref_start", open_.alias("open")))


def matches(docs: DataFrame, window: int) -> DataFrame:
    """``doc_id, text_hash, start, n, ref, ref_start``: windows ``start`` to ``start + n - 1`` are in document ``ref`` from window
    ``ref_start`` on. Every window of which a smaller id holds a copy is in one of them."""
    entries = docs.where("doc_id is not null").mapInArrow(lambda batches: _entries(batches, window), _ENTRIES)
    shared = _firsts(entries, "seed")
    found = entries.join(hinted(shared).hint("shuffle_hash"), "seed").where("open or ref < doc_id")
    found = settle(found)
    columns = ["doc_id", "text_hash", "start", "n", "ref", "ref_start"]
    # of equal entries the first one is looked up, window by window; the others are copies of it
    unsure = found.where("open").select("seed", "entry", "doc_id", "text_hash", "start", "n")
    once = unsure.groupBy("seed", "entry").agg(
        F.min("doc_id").alias("ref"), F.expr("min_by(start, doc_id)").alias("ref_start")
    )
    opened = settle(unsure.join(settle(once), ["seed", "entry"]).select(*columns))
    own = opened.where("ref = doc_id").groupBy("doc_id", "text_hash")
    leading = own.agg(F.collect_list(F.struct("start", "n")).alias("open"))
    texts = docs.join(leading, ["doc_id", "text_hash"]).select("doc_id", "text", "text_hash", "open")
    windows = settle(texts.mapInArrow(lambda batches: _windows(batches, window), _WINDOWS))
    known = _firsts(windows, "w1", "w2").drop("open")
    alone = windows.join(hinted(known).hint("shuffle_hash"), ["w1", "w2"]).where("ref < doc_id")
    return (
        found.where("not open")
        .select(*columns)
        .union(opened.where("ref < doc_id"))
        .union(alone.withColumn("n", F.lit(1)).select(*columns))
    )


def parse(begin: np.ndarray, n: np.ndarray, ref: np.ndarray, ref_begin: np.ndarray, window: int, length: int) -> list:
    """Greedy factors ``(start, words, ref, ref_start)`` of one document from its matches."""
    if not len(begin):
        return []
    shift = ref_begin - begin
    order = np.lexsort((begin, shift, ref))
    begin, end, ref, shift = begin[order], (begin + n + window - 1)[order], ref[order], shift[order]
    new = np.append(True, (ref[1:] != ref[:-1]) | (shift[1:] != shift[:-1]) | (begin[1:] > end[:-1] - window + 1))
    first = np.flatnonzero(new)
    end = np.minimum(np.maximum.reduceat(end, first), length)
    begin, ref, shift = begin[first], ref[first], shift[first]
    order = np.lexsort((ref, -end, begin))
    factors, at, best = [], -1, None
    for b, e, r, s in zip(*(x[order].tolist() for x in (begin, end, ref, shift)), strict=True):
        while best and b > at:  # the furthest match known goes on where the factor before it ends
            factors.append((at, best[0] - at, best[1], at + best[2]))
            at, best = best[0], None
        if best is None and b >= at:
            at = b
        if e > at and (best is None or e > best[0]):
            best = (e, r, s)
    if best:
        factors.append((at, best[0] - at, best[1], at + best[2]))
    return factors


def _parsed(batches: Iterable[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, limit=4 << 20):
        texts, lists = batch.column(1).to_pylist(), batch.column(2)
        offsets = lists.offsets.to_numpy()
        offsets = offsets - offsets[0]
        flat = lists.flatten()
        begin, n, ref, ref_begin = (
            flat.field(name).to_numpy(zero_copy_only=False).astype(np.int64) for name in ("start", "n", "ref", "ref_start")
        )
        total, removed, digest, kept, factors = [], [], [], [], []
        for i, text in enumerate(texts):
            own = slice(offsets[i], offsets[i + 1])
            words = _WORD.findall(text)
            found = parse(begin[own], n[own], ref[own], ref_begin[own], window, len(words))
            rest, at = [], 0
            for start, size, _, _ in found:
                rest += words[at:start]
                at = start + size
            rest += words[at:]
            left = " ".join(rest)
            total.append(len(words))
            removed.append(len(words) - len(rest))
            digest.append(hashlib.sha256(left.encode()).hexdigest())
            kept.append(left)
            factors.append([dict(zip(("start", "n", "ref", "ref_start"), x, strict=True)) for x in found])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string()),
             pa.array(kept, pa.string()), pa.array(factors, _FACTOR_TYPE)],
            ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text", "factors"],
        )


_FACTOR_TYPE = pa.list_(
    pa.struct([("start", pa.int32()), ("n", pa.int32()), ("ref", pa.int64()), ("ref_start", pa.int32())])
)


def substring_dedup(docs: DataFrame, window: int = 13) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, kept_text, factors`` of every document.

    ``factors``: start and number of words, the document they are copied from and
    the word there. ``kept_text``: the other words joined by one space.
    """
    if window < SEED:
        raise ValueError(f"a window has at least {SEED} words")
    texts = pick(docs, "doc_id", "text").withColumn("text_hash", F.xxhash64("text"))
    found = matches(texts, window)
    spans = found.groupBy("doc_id", "text_hash").agg(
        F.collect_list(F.struct("start", "n", "ref", "ref_start")).cast(_MATCHES).alias("matches")
    )
    empty = F.array().cast(_MATCHES)
    both = texts.join(spans, ["doc_id", "text_hash"], "left").select("doc_id", "text", F.coalesce("matches", empty).alias("matches"))
    schema = f"doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string, factors {_FACTORS}"
    return both.mapInArrow(lambda batches: _parsed(batches, window), schema)
