"""Periodic runs of words by block convolution (operator 13).

A run is a longest stretch of words in which words ``q`` apart are equal, ``q`` the
least such number, of at least ``repeats`` periods and ``least`` words. At each dyadic
scale B a document is cut into blocks of B words. A run of a period from B to 2B - 1
holds a whole block within its first 2B - 1 words, and that block comes again one
period on. So the sums of squared differences between a block and every place of the
2B words behind it are computed at once, as exact integers: a number-theoretic
transform modulo as many primes as the largest possible sum needs. Sums of zero give
distances; a distance over which three periods agree seeds an extension, word by word
in both directions, and what is long enough is a run. Of equal stretches the least
period counts, which was found at an earlier scale.

Only blocks that can recur are transformed: each four words of such a block stand again
less than 2B words on, which one sort of all four-word hashes tells. A document costs
O(n log n) and is handled in its own row; there is no shuffle.

Null and empty texts have no words, no runs and an empty kept text. A null id stays
null, repeated rows give repeated rows, an empty table gives none, further columns are
ignored whatever their names. Texts are never cut.
"""

from __future__ import annotations

import functools
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordmill.llm.shared import owners, pick, range_hashes, slices, words_of

#: Primes with roots of unity of order 2**27, 2**26 and 2**25, and a generator of each; fixed values.
PRIMES = ((2013265921, 31), (469762049, 3), (167772161, 3))
#: Four words tell which blocks can recur; entries of a matrix of blocks transformed at once.
GRAM, CELLS = 4, 1 << 18
_SLICE = 2 << 20
_NEVER = np.iinfo(np.int64).max
Run = tuple[int, int, int]
#: First word and period of a tail that repeats: (id, number of words) -> (begin, period).
Tail = Callable[[int | None, int], tuple[int, int] | None]


@functools.lru_cache(maxsize=128)
def _roots(prime: int, generator: int, half: int, inverse: bool) -> np.ndarray:
    """Powers 0 to half - 1 of a root of unity of order 2 * half."""
    root = pow(generator, (prime - 1) // (2 * half), prime)
    if inverse:
        root = pow(root, -1, prime)
    found = np.ones(1, np.uint64)
    while len(found) < half:
        found = np.concatenate([found, found * np.uint64(pow(root, len(found), prime)) % np.uint64(prime)])
    return found


def forward(rows: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """Transform of each row, its entries in bit-reversed order."""
    count, size = rows.shape
    half, p = size // 2, np.uint64(prime)
    while half:
        parts = rows.reshape(count, -1, 2, half)
        low, high = parts[:, :, 0], parts[:, :, 1]
        made = np.empty_like(parts)
        made[:, :, 0] = (low + high) % p
        made[:, :, 1] = (low + p - high) * _roots(prime, generator, half, False) % p
        rows, half = made.reshape(count, size), half // 2
    return rows


def backward(rows: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """Rows of which ``forward`` gives these."""
    count, size = rows.shape
    half, p = 1, np.uint64(prime)
    while half < size:
        parts = rows.reshape(count, -1, 2, half)
        low, high = parts[:, :, 0], parts[:, :, 1] * _roots(prime, generator, half, True) % p
        made = np.empty_like(parts)
        made[:, :, 0] = (low + high) % p
        made[:, :, 1] = (low + p - high) % p
        rows, half = made.reshape(count, size), 2 * half
    return rows * np.uint64(pow(size, -1, prime)) % p


def zero_sums(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Whether block r equals windows[r, k:k + B], for each r and each k below B: its squared differences sum to 0.

    A sum is at most B times the square of the largest code; it is zero exactly if it is zero
    modulo primes whose product is larger.
    """
    count, size = blocks.shape
    largest = size * int(max(blocks.max(initial=0), windows.max(initial=0))) ** 2
    found, product, rows = np.ones((count, size), bool), 1, np.arange(count)
    for prime, generator in PRIMES:
        p = np.uint64(prime)
        own, behind = blocks[rows].astype(np.uint64) % p, windows[rows].astype(np.uint64) % p
        turned = np.zeros((len(rows), 2 * size), np.uint64)
        turned[:, 0], turned[:, size + 1 :] = own[:, 0], own[:, :0:-1]
        crossed = forward(behind, prime, generator) * forward(turned, prime, generator) % p
        products = backward(crossed, prime, generator)[:, :size]
        total = np.zeros((len(rows), 2 * size + 1), np.uint64)
        np.cumsum(behind * behind % p, axis=1, out=total[:, 1:])
        squares = total[:, size : 2 * size] - total[:, :size] + np.sum(own * own % p, axis=1, dtype=np.uint64)[:, None]
        found[rows] &= (squares % p + p + p - products - products) % p == 0
        product *= prime
        rows = rows[found[rows].any(axis=1)]
        if product > largest or not len(rows):
            return found
    raise ValueError("the codes are too large for these primes")


def recurrences(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each word, how far on the ``GRAM`` words from it stand again in the text; ``_NEVER`` if they don't."""
    n = len(codes)
    far = np.full(n, _NEVER)
    ends = np.repeat(starts[1:], np.diff(starts))
    at = np.flatnonzero(np.arange(n) + GRAM <= ends)
    if not len(at):
        return far
    keys = range_hashes(codes.astype(np.uint64) + np.uint64(1), at, np.full(len(at), GRAM))
    keys ^= owners(starts)[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    first, second = at[order[:-1][same]], at[order[1:][same]]
    inside = second < ends[first]
    far[first[inside]] = (second - first)[inside]
    return far


def _blocks(far: np.ndarray, codes: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of the blocks that can recur at this scale, with two block lengths behind them, and their texts."""
    sizes = np.diff(starts)
    number = np.maximum(sizes // size - 2, 0)
    of = np.repeat(np.arange(len(number)), number)
    first = starts[of] + size * (np.arange(len(of)) - np.repeat(np.cumsum(number) - number, number))
    if not len(first):
        return first, of
    if size == 1:
        can = codes[first] == codes[first + 1]
    else:
        edges = np.stack([first, first + size], axis=1).ravel()
        can = np.maximum.reduceat(far, edges)[::2] < 2 * size
    return first[can], of[can]


def _seeds(codes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks (as places in ``first``) and distances at which they come again within their window."""
    rows, shifts = [], []
    step = max(1, CELLS // (2 * size))
    for k in range(0, len(first), step):
        at = first[k : k + step, None]
        found = zero_sums(codes[at + np.arange(size)], codes[at + np.arange(size, 3 * size)])
        row, shift = np.nonzero(found)
        rows.append(row + k)
        shifts.append(shift + size)
    return np.concatenate(rows), np.concatenate(shifts)


def _extended(words: np.ndarray, at: int, period: int) -> Run:
    """Longest stretch (begin, end, period) around place ``at`` whose words ``period`` apart are equal."""
    begin, end, n = at, at, len(words)
    reach = 4 * period
    while end + period < n:
        stop = min(end + reach, n - period)
        differ = words[end:stop] != words[end + period : stop + period]
        if differ.any():
            end += int(differ.argmax())
            break
        end, reach = stop, 2 * reach
    reach = 4 * period
    while begin:
        low = max(begin - reach, 0)
        differ = (words[low:begin] != words[low + period : begin + period])[::-1]
        if differ.any():
            begin -= int(differ.argmax())
            break
        begin, reach = low, 2 * reach
    return begin, end + period, period


def runs_of(codes: np.ndarray, starts: np.ndarray, repeats: int = 4, least: int = 6) -> dict[int, list[Run]]:
    """Runs (begin, end, period) of each text that has any, by begin and period; ``repeats`` is 4 or more."""
    if repeats < 4:
        raise ValueError("blocks find runs of four periods and more")
    far, found = recurrences(codes, starts), defaultdict(dict)
    longest, size = int(np.diff(starts).max(initial=0)), 1
    while repeats * size <= longest:
        first, of = _blocks(far, codes, starts, size)
        if len(first):
            row, period = _seeds(codes, first, size)
            at, text = first[row], of[row]
            room = at + 3 * period <= starts[text + 1]
            at, text, period = at[room], text[room], period[room]
            agree = range_hashes(codes.astype(np.uint64) + np.uint64(1), np.concatenate([at, at + period]), np.tile(2 * period, 2))
            agree = agree[: len(at)] == agree[len(at) :]
            at, text, period = at[agree], text[agree], period[agree]
            order = np.lexsort((at, period, text))
            at, text, period = at[order], text[order], period[order]
            # overlapping places of one distance lie in one stretch
            alone = np.append(True, (np.diff(text) != 0) | (np.diff(period) != 0) | (np.diff(at) > 2 * period[:-1]))[: len(at)]
            for i, t, q in zip(at[alone].tolist(), text[alone].tolist(), period[alone].tolist(), strict=True):
                own, place = found[t], i - int(starts[t])
                if any(b <= place and place + 3 * q <= e and q % p == 0 for b, e, p in own.values()):
                    continue
                begin, end, _ = _extended(codes[starts[t] : starts[t + 1]], place, q)
                if end - begin >= max(least, repeats * q) and (begin, end) not in own:
                    own[begin, end] = (begin, end, q)
        size *= 2
    return {t: sorted(own.values(), key=lambda r: (r[0], r[2])) for t, own in found.items() if own}


def with_tails(codes: np.ndarray, starts: np.ndarray, ids: list, tail: Tail) -> np.ndarray:
    """The words after ``tail`` made some texts end in repeats of a stretch."""
    source = np.arange(len(codes))
    for i, doc_id in enumerate(ids):
        low, high = int(starts[i]), int(starts[i + 1])
        made = tail(doc_id, high - low)
        if made is not None:
            begin, period = low + made[0], made[1]
            source[begin:high] = begin + (np.arange(high - begin) % period)
    return codes[source]


_FOUND = "doc_id long, runs array<struct<start: long, length: long, period: long>>, kept_text string"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _find(batches: Iterable[pa.RecordBatch], repeats: int, least: int, tail: Tail | None) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, limit=_SLICE):
        words = words_of(batch.column(1))
        strings, starts, ids = words.strings(), words.starts, batch.column(0).to_pylist()
        codes = words.codes.astype(np.int64)
        if tail is not None:
            codes = with_tails(codes, starts, ids, tail)
        runs = runs_of(codes, starts, repeats, least)
        spans, texts = [], []
        for i in range(len(ids)):
            own, kept = codes[starts[i] : starts[i + 1]], None
            for begin, end, period in runs.get(i, ()):
                kept = np.ones(len(own), bool) if kept is None else kept
                kept[begin + period : end] = False
            texts.append(" ".join(map(strings.__getitem__, (own if kept is None else own[kept]).tolist())))
            spans.append([{"start": b, "length": e - b, "period": q} for b, e, q in runs.get(i, ())])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(spans, _RUNS), pa.array(texts, pa.string())], ["doc_id", "runs", "kept_text"]
        )


def periodic_runs(docs: DataFrame, repeats: int = 4, least: int = 6, tail: Tail | None = None) -> DataFrame:
    """``doc_id, runs, kept_text`` of every whole text.

    Runs are ordered by start, then period, and count words from 0. The kept text has one
    space between words and no word that a run holds behind its first period. ``tail`` alters
    the words of a text before the search.
    """
    return pick(docs, "doc_id", "text").mapInArrow(lambda batches: _find(batches, repeats, least, tail), _FOUND)


def report(found: DataFrame) -> DataFrame:
    """A row of numbers and hashes per row of ``periodic_runs``; ``start`` to ``exponent_milli`` are of the run of most periods."""
    best = F.aggregate(
        "runs",
        F.get("runs", F.lit(0)),
        lambda a, r: F.when(r["length"] * a["period"] > a["length"] * r["period"], r).otherwise(a),
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("kept_text").cast("binary"), 256).alias("collapsed_sha256"),
    )
