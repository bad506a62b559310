"""Quality rules by a hashed n-gram log-likelihood ratio (operator 6).

Words and pairs of words are hashed into ``2 ** bits`` buckets. Two multinomials
over the buckets are counted, one of the trusted documents, one of all documents.
A document's score is the mean log ratio of its n-grams, trusted against all, so
length cancels; it is kept from ``threshold`` on. Bucket weights are whole
millionths, so sums and verdicts don't depend on order or partitioning.

Each task adds up its buckets before anything is shuffled. What reaches the
driver are the buckets, a number fixed by ``bits``.

Base rules come with it: word, symbol, repeated line and repeated window counts,
and ``base_failed`` for texts that are too short or mostly repeats.

Null texts have no words and fail the base rules. Null ids are judged like
others but are never trusted. Repeated rows count each. Without trusted documents
or words every score is 0. Texts are never cut.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordmill.llm.shared import hashed_words, hinted, mixed, owners, pick, settle, slices, sums, words_of

#: Weights are in millionths.
UNIT = 1_000_000
_SYMBOLS = re.compile(r"[#*$%&|<>]")
_RESULT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, score_millionths long, kept boolean"
)


def grams(texts: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words and pairs of words of the texts, and the text of each."""
    words, starts = hashed_words(texts)
    text = owners(starts)
    paired = text[1:] == text[:-1]
    pairs = mixed(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:])[paired]
    buckets = np.concatenate([words, pairs]) >> np.uint64(64 - bits)
    return buckets.astype(np.int64), np.concatenate([text, text[1:][paired]])


def _count(batches: Iterable[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    raw, target = np.zeros(1 << bits, np.int64), np.zeros(1 << bits, np.int64)
    for batch in slices(batches, limit=2 << 20):
        buckets, text = grams(batch.column(1), bits)
        trusted = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
        raw += np.bincount(buckets, minlength=1 << bits)
        target += np.bincount(buckets[trusted[text]], minlength=1 << bits)
    used = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays(
        [pa.array(used), pa.array(raw[used]), pa.array(target[used])], ["bucket", "raw", "target"]
    )


def weights(docs: DataFrame, trusted: DataFrame, bits: int) -> np.ndarray:
    """Log ratio of each bucket in millionths, with one added to every count."""
    ids = settle(pick(trusted, "doc_id").where("doc_id is not null").distinct().withColumn("trusted", F.lit(True)))
    marked = pick(docs, "doc_id", "text").join(hinted(ids), "doc_id", "left")
    marked = marked.select("doc_id", "text", F.coalesce("trusted", F.lit(False)).alias("trusted"))
    counted = marked.mapInArrow(lambda batches: _count(batches, bits), "bucket long, raw long, target long")
    found = counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    raw, target = np.ones(1 << bits), np.ones(1 << bits)
    raw[found["bucket"]] += found["raw"]
    target[found["bucket"]] += found["target"]
    if not len(found) or found["target"].sum() == 0:
        return np.zeros(1 << bits, np.int64)
    ratio = np.log(target / target.sum()) - np.log(raw / raw.sum())
    return np.rint(ratio * UNIT).astype(np.int64)


def repeated_lines(texts: pa.Array) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    lists = pc.split_pattern(texts, "\n")
    coded = lists.flatten().dictionary_encode()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    worded = np.diff(hashed_words(coded.dictionary)[1]) > 0
    keep = worded[codes]
    text = owners(offsets - offsets[0])[keep]
    key = text * (len(worded) + 1) + codes[keep]
    n = len(texts)
    return np.bincount(text, minlength=n) - np.bincount(np.unique(key) // (len(worded) + 1), minlength=n)


def repeated_words(codes: np.ndarray) -> int:
    """Words in windows of three that occur twice or more."""
    if len(codes) < 3:
        return 0
    pair = codes[:-1].astype(np.int64) << 32 | codes[1:]
    pair = np.unique(pair, return_inverse=True)[1][:-1].astype(np.int64)
    _, place, number = np.unique(pair << 32 | codes[2:], return_inverse=True, return_counts=True)
    twice = number[place] > 1
    covered = np.zeros(len(codes), bool)
    for k in range(3):
        covered[k : k + len(twice)] |= twice
    return int(covered.sum())


def _judge(batches: Iterable[pa.RecordBatch], weight: np.ndarray, bits: int, threshold: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, limit=2 << 20):
        texts = batch.column(1)
        words, n = words_of(texts), batch.num_rows
        strings = words.strings()
        chars = pc.utf8_length(words.vocabulary).to_numpy(zero_copy_only=False).astype(np.int64)
        symbols = np.fromiter((len(_SYMBOLS.findall(w)) for w in strings), np.int64, len(strings))
        counts = np.diff(words.starts)
        repeats = np.array(
            [repeated_words(words.codes[a:b]) for a, b in zip(words.starts, words.starts[1:], strict=False)], np.int64
        )
        buckets, text = grams(texts, bits)
        order = np.argsort(text, kind="stable")
        bounds = np.searchsorted(text[order], np.arange(n + 1))
        total, number = sums(weight[buckets[order]], bounds), np.diff(bounds)
        score = total // np.maximum(number, 1)
        failed = (counts < 50) | (100 * repeats > 50 * counts)
        empty = np.zeros(0, np.int64)
        columns = [
            counts,
            sums(chars[words.codes] if len(strings) else empty, words.starts),
            sums(symbols[words.codes] if len(strings) else empty, words.starts),
            repeated_lines(texts),
            repeats,
            failed,
            score,
            ~failed & (score >= threshold),
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *map(pa.array, columns)], [x.split()[0] for x in _RESULT.split(", ")]
        )


def quality_rules(docs: DataFrame, trusted: DataFrame, bits: int = 16, threshold: float = -0.1) -> DataFrame:
    """Base counts, ``base_failed``, ``score_millionths`` and ``kept`` of every document.

    ``trusted``: a table with the ids of documents known to be good, column doc_id.
    """
    weight = weights(docs, trusted, bits)
    least = round(threshold * UNIT)
    return pick(docs, "doc_id", "text").mapInArrow(lambda batches: _judge(batches, weight, bits, least), _RESULT)
