"""Quality classifier by co-training of two views (operator 2).

One view reads the content of a text (hashed words, word pairs, word shapes,
immediate repeats), the other what a crawl records about a page (source,
language, size, lines, shares of capitals, marks, digits and distinct words).
Each is a logistic regression. Both start from labelled rows, at most ``labelled`` of
them, chosen by a hash of their ids, whose hashed features the driver holds; a
quarter of these is held out.

In every round both views give a margin to every document. The documents that a view is
surest of, by quantiles of all its margins in the proportion of the classes, are labelled
for the other view; their share of all documents grows by ``growth`` a round and has no
other bound. Both are fitted on: each step sums the slopes of the pseudo-labelled rows on
Spark, in whole numbers, so that their order does not matter, and adds those of the
labelled rows. Only weights, sums by weight and a histogram of margins pass the driver.

On the held-out rows each view's margins are calibrated; the calibrated log odds are
added, less the prior that both contain, and score every document where it is read.

Null texts and texts without a word are rejected with score 0 and not fitted on. Null
metadata is a value of its own. Rows with a null id are scored but not fitted on. Rows
that repeat an id are scored each; a label counts for the first of them by their content,
and they are pseudo-labelled by their least margins together. Of several labels of an id
the smallest counts. Without labels of both classes every other text gets 0.5 and is kept.
Texts are never cut.
"""

from __future__ import annotations

import functools
import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordmill.llm.shared import DOCUMENT, Recent, hinted, kept_by, mixed, owners, pick, settle, slices, sums, words_of

#: Dimensions: hashed words and pairs, hashed shapes, and one for a word that repeats the one before.
GRAMS, SHAPES = 1 << 14, 1 << 9
TEXT_WIDTH = GRAMS + SHAPES + 1
SOURCES, LANGS, BINS, MEASURES = 256, 32, 16, 7
META_WIDTH = SOURCES + LANGS + BINS * MEASURES
#: Words of which a worker keeps what it needs, in each of two generations; bytes of text handled at once.
KEPT_WORDS, _SLICE = 150_000, 2 << 20
#: Steps of a margin in the histogram, and its largest margin.
_STEP, _FAR = 64, 32
#: Slopes are summed in multiples of this.
_UNIT = 2.0**-40
_FEATURES = "doc_id long, quality int, role int, text_at binary, text_value binary, meta_at binary"
_SCORES = "doc_id long, p_text double, p_meta double, score double, kept boolean"


@functools.lru_cache
def _shape_table() -> bytes:
    kinds = bytearray(range(256))
    for c in range(256):
        if c >= 128 or chr(c).islower():
            kinds[c] = ord("a")
        elif chr(c).isupper():
            kinds[c] = ord("A")
        elif chr(c).isdigit():
            kinds[c] = ord("9")
    return bytes(kinds)


#: ``Heesble,`` has the shape ``Aa,`` and ``the&&&`` has ``a&``.
_RUN = re.compile(rb"(.)\1+", re.DOTALL)


@dataclass
class Sparse:
    """Rows of (column, value) pairs; ``row`` ascends."""

    row: np.ndarray
    at: np.ndarray
    value: np.ndarray
    n: int

    def margins(self, weight: np.ndarray, bias: float) -> np.ndarray:
        return np.bincount(self.row, self.value * weight[self.at], self.n) + bias

    def take(self, rows: np.ndarray) -> Sparse:
        place = np.full(self.n, -1, np.int32)
        place[rows] = np.arange(len(rows))
        inside = place[self.row] >= 0
        return Sparse(place[self.row[inside]], self.at[inside], self.value[inside], len(rows))


def features(batch: pa.RecordBatch) -> tuple[Sparse, Sparse, np.ndarray]:
    """Both views of a batch of documents, and their numbers of words."""
    texts, n = batch.column("text"), batch.num_rows
    words = words_of(texts)
    raw = words.strings()
    kept = kept_by("quality_classifier")
    known, shapes = kept.setdefault("words", Recent(KEPT_WORDS)), kept.setdefault("shapes", {})
    new = known.missing(raw)
    known.newer.update((word, _facts(word, shapes)) for word in new)
    facts = np.frombuffer(b"".join(known.values(raw)), _FACTS)
    each, kinds = facts["hash"].astype(np.uint64), facts["kind"].astype(np.int64)
    codes, text, counts = words.codes, owners(words.starts), np.diff(words.starts)
    hashed = mixed(each[codes]) if len(raw) else np.zeros(0, np.uint64)
    paired = text[1:] == text[:-1]
    pairs = mixed(hashed[:-1] * np.uint64(3) + hashed[1:])[paired]
    again = (codes[1:] == codes[:-1]) & paired
    at = np.concatenate([
        (hashed % np.uint64(GRAMS)).astype(np.int64),
        (pairs % np.uint64(GRAMS)).astype(np.int64),
        GRAMS + (kinds[codes] if len(raw) else np.zeros(0, np.int64)),
        np.full(int(again.sum()), TEXT_WIDTH - 1),
    ])
    row = np.concatenate([text, text[1:][paired], text, text[1:][again]])
    key = np.sort(row * TEXT_WIDTH + at)
    heads = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    number, key = np.diff(np.append(heads, len(key))), key[heads]
    row, value = key // TEXT_WIDTH, np.log1p(number)
    norm = np.sqrt(np.bincount(row, value * value, n))
    content = Sparse(row, key % TEXT_WIDTH, value / np.maximum(norm, 1e-9)[row], n)

    upper, marks, digits, sizes = (facts[name].astype(np.int64) for name in ("upper", "marks", "digits", "size"))
    total = [sums(x[codes] if len(raw) else x, words.starts) for x in (upper, marks, digits, sizes)]
    held = np.sort(text * (len(raw) + 1) + codes)
    distinct = np.bincount(held[np.append(True, held[1:] != held[:-1])] // (len(raw) + 1), minlength=n) if len(raw) else counts
    lines = pc.count_substring(texts, "\n").to_numpy(zero_copy_only=False) + 1
    chars = np.maximum(total[3], 1)
    several = np.maximum(counts, 1)
    measures = [
        np.log2(1 + chars),
        np.log2(1 + lines),
        np.log2(1 + counts / lines),
        total[0] / chars * 16,
        total[1] / chars * 32,
        total[2] / chars * 32,
        distinct / several * 16,
    ]
    columns = [
        _category(batch.column("source"), SOURCES),
        SOURCES + _category(batch.column("lang"), LANGS),
        *[SOURCES + LANGS + BINS * k + np.clip(m, 0, BINS - 1).astype(np.int64) for k, m in enumerate(measures)],
    ]
    meta = np.stack(columns, 1)
    page = Sparse(np.repeat(np.arange(n), meta.shape[1]), meta.ravel(), np.ones(meta.size), n)
    return content, page, counts


_MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())
#: What is kept of a word: hash, hashed shape, capitals, marks, digits, bytes.
_FACTS = np.dtype([("hash", "<u4"), ("kind", "<u4"), ("upper", "<u4"), ("marks", "<u4"), ("digits", "<u4"), ("size", "<u4")])
_PACKED = struct.Struct("<6I")


def _kind(shaped: bytes, kinds: dict[bytes, int]) -> int:
    """The hashed shape of a word; ``kinds`` keeps those met, and begins anew when it is full."""
    kind = kinds.get(shaped)
    if kind is None:
        if len(kinds) >= 1 << 15:
            kinds.clear()
        kind = kinds[shaped] = zlib.crc32(_RUN.sub(rb"\1", shaped)) % SHAPES
    return kind


def _facts(word: str, kinds: dict[bytes, int]) -> bytes:
    raw = word.encode()
    size, shaped = len(raw), raw.translate(_shape_table())
    upper, digits = shaped.count(b"A"), shaped.count(b"9")
    marks = 0 if shaped.count(b"a") + upper + digits == size else size - len(raw.translate(None, _MARKS))
    return _PACKED.pack(zlib.crc32(raw), _kind(shaped, kinds), upper, marks, digits, size)


def _category(column: pa.Array, size: int) -> np.ndarray:
    """A hashed category; null is the first."""
    coded = column.dictionary_encode()
    each = [1 + zlib.crc32(x.encode()) % (size - 1) for x in coded.dictionary.to_pylist()] + [0]
    return np.array(each, np.int64)[pc.fill_null(coded.indices, len(each) - 1).to_numpy(zero_copy_only=False)]


def _extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, limit=_SLICE):
        content, page, _ = features(batch)
        bounds = np.searchsorted(content.row, np.arange(batch.num_rows + 1))
        own = [slice(a, b) for a, b in zip(bounds, bounds[1:], strict=False)]
        meta = page.at.reshape(batch.num_rows, -1).astype(np.int32)
        columns = [
            batch.column("doc_id"),
            batch.column("quality"),
            batch.column("role"),
            pa.array([content.at[s].astype(np.int32).tobytes() for s in own], pa.binary()),
            pa.array([content.value[s].astype(np.float32).tobytes() for s in own], pa.binary()),
            pa.array([x.tobytes() for x in meta], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in _FEATURES.split(", ")])


def _stack(ats: list[bytes], values: list[bytes] | None) -> Sparse:
    lengths = np.array([len(x) // 4 for x in ats], np.int64)
    at = np.frombuffer(b"".join(ats), np.int32)
    value = np.ones(len(at), np.float32) if values is None else np.frombuffer(b"".join(values), np.float32)
    return Sparse(np.repeat(np.arange(len(ats), dtype=np.int32), lengths), at, value, len(ats))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(x: Sparse, y: np.ndarray, width: int, steps: int = 120, ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression by full-batch Adam; classes weigh the same."""
    weight, bias = np.zeros(width), 0.0
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    for step in range(1, steps + 1):
        error = (_sigmoid(x.margins(weight, bias)) - y) * share
        slope = np.append(np.bincount(x.at, x.value * error[x.row], width) + ridge * weight, error.sum())
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope * slope
        move = 0.3 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        weight, bias = weight - move[:-1], bias - move[-1]
    return weight, bias


def calibrate(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn margins into log odds (Platt's smoothed targets, Newton steps)."""
    good, bad = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    scale = max(float(np.abs(margins).mean()), 1e-9)
    x = np.stack([margins / scale, np.ones(len(margins))], 1)
    b = np.zeros(2)
    for _ in range(50):
        p = _sigmoid(x @ b)
        slope = x.T @ (p - target) + 1e-3 * b
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        b = b - np.clip(np.linalg.solve(curve, slope), -2, 2)
    return float(max(b[0], 0.0) / scale), float(b[1])


@dataclass
class Model:
    views: list[tuple[np.ndarray, float]]
    calibrations: list[tuple[float, float]]
    prior: float

    def log_odds(self, content: Sparse, page: Sparse) -> list[np.ndarray]:
        both = zip((content, page), self.views, self.calibrations, strict=True)
        return [a * x.margins(*view) + b for x, view, (a, b) in both]


def _margins(batches: Iterable[pa.RecordBatch], views: list) -> Iterator[pa.RecordBatch]:
    """Both margins of each document with a word, in steps of the histogram."""
    for batch in slices(batches, limit=_SLICE):
        content, page, counts = features(batch)
        found = [np.rint(np.clip(x.margins(*view), -_FAR, _FAR) * _STEP) for x, view in zip((content, page), views, strict=True)]
        kept = pa.array(counts > 0)
        columns = [batch.column("doc_id"), *[pa.array(m.astype(np.int32)) for m in found]]
        yield pa.RecordBatch.from_arrays([c.filter(kept) for c in columns], ["doc_id", "m0", "m1"])


def _bounds(margins: DataFrame, taken: float, good: float) -> list[tuple[int, int, int, int]]:
    """Of each view: the highest bad margin, the lowest good one, and how many documents have such margins."""
    bins = margins.select(F.explode(F.array(*[F.struct(F.lit(k).alias("view"), F.col(f"m{k}").alias("m")) for k in (0, 1)])).alias("b"))
    number = {(r.view, r.m): r["count"] for r in bins.groupBy("b.view", "b.m").count().collect()}  # a row per step of margin
    found = []
    for view in (0, 1):
        own = sorted((m, n) for (v, m), n in number.items() if v == view)
        every, ends = sum(n for _, n in own), []
        for side, share in ((own, 1 - good), (own[::-1], good)):
            bound, count, sign = None, 0, -1 if side is own else 1
            for m, n in side:
                if m * sign <= 0 or count >= taken * share * every:
                    break
                bound, count = m, count + n
            ends.append((sign * (_FAR * _STEP + 1) if bound is None else bound, count))
        found.append((ends[0][0], ends[1][0], ends[0][1], ends[1][1]))
    return found


_PSEUDO = "doc_id long, quality int, role int, text_at binary, text_value binary, meta_at binary"


def _slopes(batches: Iterable[pa.RecordBatch], views: list, shares: list[tuple[float, float]]) -> Iterator[pa.RecordBatch]:
    """Slopes of a partition's pseudo-labelled rows by weight, in whole units. ``quality`` labels view 0, ``role`` view 1."""
    sums_ = [np.zeros(TEXT_WIDTH + 1), np.zeros(META_WIDTH + 1)]
    for batch in batches:
        stacked = (
            _stack(batch.column("text_at").to_pylist(), batch.column("text_value").to_pylist()),
            _stack(batch.column("meta_at").to_pylist(), None),
        )
        for k, (x, name) in enumerate(zip(stacked, ("quality", "role"), strict=True)):
            y = batch.column(name).to_numpy()
            share = np.where(y == 1, shares[k][1], np.where(y == 0, shares[k][0], 0.0))
            error = (_sigmoid(x.margins(*views[k])) - y) * share
            sums_[k][:-1] += np.bincount(x.at, np.rint(x.value * error[x.row] / _UNIT), len(sums_[k]) - 1)
            sums_[k][-1] += np.rint(error / _UNIT).sum()
    for k, total in enumerate(sums_):
        at = np.flatnonzero(total)
        columns = [pa.array(np.full(len(at), k, np.int32)), pa.array(at.astype(np.int32)), pa.array(total[at].astype(np.int64))]
        yield pa.RecordBatch.from_arrays(columns, ["view", "at", "units"])


def _local_slope(x: Sparse, y: np.ndarray, view: tuple, share: np.ndarray, width: int) -> np.ndarray:
    error = (_sigmoid(x.margins(*view)) - y) * share
    return np.append(np.bincount(x.at, x.value * error[x.row], width), error.sum())


def refit(views: list, known: list[Sparse], y: np.ndarray, pseudo: DataFrame, counts: list[tuple[int, int]], steps: int, ridge: float = 1e-4) -> list:
    """Both views fitted on from where they are, on labelled rows (here) and pseudo-labelled ones (on Spark); classes weigh the same."""
    widths = (TEXT_WIDTH, META_WIDTH)
    shares = [(0.5 / max(1, bad + int((y == 0).sum())), 0.5 / max(1, good + int((y == 1).sum()))) for bad, good in counts]
    state = [[np.zeros(w + 1), np.zeros(w + 1)] for w in widths]
    for step in range(1, steps + 1):
        sent = list(views)
        slopes = pseudo.mapInArrow(lambda batches, sent=sent: _slopes(batches, sent, shares), "view int, at int, units long")
        summed = slopes.groupBy("view", "at").agg(F.sum("units").alias("units")).toArrow()  # a row per weight
        view, at, units = (summed.column(name).to_numpy() for name in ("view", "at", "units"))
        for k, width in enumerate(widths):
            weight, bias = views[k]
            share = np.where(y == 1, shares[k][1], shares[k][0])
            slope = _local_slope(known[k], y, views[k], share, width)
            slope[at[view == k]] += units[view == k] * _UNIT
            slope[:-1] += ridge * weight
            m, v = state[k]
            m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope * slope
            state[k] = [m, v]
            move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
            views[k] = (weight - move[:-1], bias - move[-1])
    return views


def train(docs: DataFrame, labels: DataFrame, labelled: int = 3000, rounds: int = 2, growth: float = 0.01, steps: int = 15) -> Model | None:
    """The model: fitted on at most ``labelled`` labelled documents, then on what both views label among all others."""
    mark = F.xxhash64("doc_id", F.lit(2))
    every = pick(labels, "doc_id", "quality").where("doc_id is not null and quality in (0, 1)")
    every = settle(every.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality")))
    chosen = every.orderBy(mark, "doc_id").limit(labelled)
    sample = chosen.select("doc_id", "quality", F.pmod(mark, F.lit(4)).cast("int").alias("role"))
    texts = pick(docs, *DOCUMENT)
    # at most ``labelled`` rows of three numbers
    found = settle(texts.join(F.broadcast(settle(sample)), "doc_id").mapInArrow(_extract, _FEATURES))
    rows: dict = {}
    for r in found.toLocalIterator():
        if r.doc_id not in rows or bytes(r.text_at) < bytes(rows[r.doc_id].text_at):
            rows[r.doc_id] = r
    order = sorted(rows)
    quality = np.array([rows[i].quality for i in order], np.int64)
    held = np.array([rows[i].role == 0 for i in order], bool)
    seen = [
        _stack([bytes(rows[i].text_at) for i in order], [bytes(rows[i].text_value) for i in order]),
        _stack([bytes(rows[i].meta_at) for i in order], None),
    ]
    del rows
    known, tested = np.flatnonzero(~held), np.flatnonzero(held)
    if len(set(quality[known])) < 2 or len(set(quality[tested])) < 2:
        return None
    own, y, widths = [x.take(known) for x in seen], quality[known], (TEXT_WIDTH, META_WIDTH)
    views, good = [fit(x, y, width) for x, width in zip(own, widths, strict=True)], float(y.mean())
    for turn in range(1, rounds + 1):
        sent = list(views)
        judged = texts.where("doc_id is not null").mapInArrow(lambda batches, sent=sent: _margins(batches, sent), "doc_id long, m0 int, m1 int")
        least = settle(judged).groupBy("doc_id").agg(F.min("m0").alias("m0"), F.min("m1").alias("m1"))
        margins = settle(least.join(every, "doc_id", "left_anti"))
        (bad0, good0, n_bad0, n_good0), (bad1, good1, n_bad1, n_good1) = _bounds(margins, growth * turn, good)
        if not n_bad0 + n_good0 + n_bad1 + n_good1:
            break
        label = lambda m, low, high: F.when(F.col(m) >= high, 1).when(F.col(m) <= low, 0).otherwise(-1)
        sure = margins.select("doc_id", label("m1", bad1, good1).alias("quality"), label("m0", bad0, good0).alias("role"))
        sure = settle(sure.where("quality >= 0 OR role >= 0"))
        pseudo = settle(texts.join(hinted(sure), "doc_id").mapInArrow(_extract, _PSEUDO))
        views = refit(views, own, y, pseudo, [(n_bad1, n_good1), (n_bad0, n_good0)], steps)
    odds = [calibrate(x.margins(*f)[tested], quality[tested]) for x, f in zip(seen, views, strict=True)]
    prior = float(quality[tested].mean())
    return Model(views, odds, float(np.log(prior / (1 - prior))))


def _judged(batch: pa.RecordBatch, model: Model | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    content, page, counts = features(batch)
    if model is None:
        half = np.where(counts > 0, 0.5, 0.0)
        return half, half, half
    one, two = model.log_odds(content, page)
    every = (_sigmoid(one), _sigmoid(two), _sigmoid(one + two - model.prior))
    return tuple(np.where(counts > 0, p, 0.0) for p in every)


def _score(batches: Iterable[pa.RecordBatch], model: Model | None, least: float) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, limit=_SLICE):
        p = _judged(batch, model)
        columns = [batch.column("doc_id"), *map(pa.array, p), pa.array(p[2] >= least)]
        yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in _SCORES.split(", ")])


def _accept(batches: Iterable[pa.RecordBatch], model: Model | None, least: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = [_judged(part, model)[2] >= least for part in slices([batch], limit=_SLICE)]
        yield batch.filter(pa.array(np.concatenate(kept) if kept else np.zeros(0, bool)))


def score(docs: DataFrame, labels: DataFrame, least: float = 0.5, **bounds) -> DataFrame:
    """``doc_id, p_text, p_meta, score, kept`` of every document."""
    model = train(docs, labels, **bounds)
    return pick(docs, *DOCUMENT).mapInArrow(lambda batches: _score(batches, model, least), _SCORES)


def accepted(docs: DataFrame, labels: DataFrame, least: float = 0.5, **bounds) -> DataFrame:
    """The documents of good quality, in the columns of documents."""
    model, texts = train(docs, labels, **bounds), pick(docs, *DOCUMENT)
    return texts.mapInArrow(lambda batches: _accept(batches, model, least), texts.schema)
