"""Byte-level byte-pair encoding and decoding with DuckDB inside each partition (operator 11).

A text is cut by the vocabulary's pattern into words, whose bytes become rows
``word, position, id``. A recursive query joins neighbouring rows with the merge
table (every pair of ids whose joined bytes are an id) and contracts each word's
leftmost pair of lowest rank until no pair is left. A step also contracts the
further places of the same rank, from the left and without overlap, if every longer
id around the new one ranks behind it: these are the next steps of the same rule,
and ``aaaa...`` takes few steps. Words that are an id as a whole are that id. Words
of more than ``CUT`` bytes are first parted where no id of the vocabulary spans the
place, which no merge can cross.

Decoding joins ids with their bytes and aggregates these in order, a document in
runs of at most ``RUN`` ids.

A worker keeps the ids of the pieces of text and of the words it met lately, up to
``KEPT`` of each in two generations. DuckDB runs in memory with one thread and a fixed
limit, spills nowhere, and gets about ``BATCH`` bytes of words at a time (one piece may
exceed it). Short pieces are contracted pair by pair, and all their steps are kept
until the last; of longer ones only the latest state of each position is kept.

Null texts count as empty: no ids, the hashes of nothing. Special strings are plain
text. A null id stays null, repeated rows give repeated rows, an empty table gives
none, further columns are ignored whatever their names. Texts are never cut short.
"""

from __future__ import annotations

import base64
import bisect
import functools
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from recordmill.llm.shared import Recent, chunks_of, gather, kept_by, pick, slices, sums

KEPT = 250_000
BATCH = 100_000
CUT = 48
RUN = 1 << 16
MEMORY = "600MB"
_SLICE = 4 << 20

#: For pieces of at most ``CUT`` bytes.
_ENCODE_SHORT = """
WITH RECURSIVE s(w, i, t, size, step) AS (
  SELECT w, i, t, 1, 0 FROM symbols
  UNION ALL
  (
  WITH pairs AS (
    SELECT a.w, a.i, a.t, a.size, a.step, m.made, a.i + a.size AS j, a.size + b.size AS joined
    FROM s a
    LEFT JOIN s b ON b.w = a.w AND b.i = a.i + a.size
    LEFT JOIN merges m ON m.l = a.t AND m.r = b.t
  ), lowest AS (
    SELECT w, arg_min({'i': i, 'j': j, 'made': made, 'joined': joined}, made::BIGINT << 32 | i) AS pair
    FROM pairs WHERE made IS NOT NULL GROUP BY w
  )
  SELECT p.w, p.i, CASE WHEN p.i = o.pair.i THEN o.pair.made ELSE p.t END,
         CASE WHEN p.i = o.pair.i THEN o.pair.joined ELSE p.size END, p.step + 1
  FROM pairs p JOIN lowest o ON o.w = p.w WHERE p.i <> o.pair.j
  )
), ended AS (
  SELECT w, max(step) AS step FROM s GROUP BY w
)
SELECT w, list(t ORDER BY i) AS ids FROM s SEMI JOIN ended e ON e.w = s.w AND e.step = s.step GROUP BY w ORDER BY w
"""

#: For longer ones.
_ENCODE_LONG = """
WITH RECURSIVE s(w, i, t, size, step) USING KEY (w, i) AS (
  SELECT w, i, t, 1, 0 FROM symbols
  UNION
  (
  WITH pairs AS (
    SELECT a.w, a.i, a.t, a.size, a.step, m.made, m.calm, a.i + a.size AS j, a.size + b.size AS joined
    FROM s a
    LEFT JOIN s b ON b.w = a.w AND b.i = a.i + a.size AND b.t IS NOT NULL
    LEFT JOIN merges m ON m.l = a.t AND m.r = b.t
    WHERE a.t IS NOT NULL
  ), lowest AS (
    SELECT w, min(made::BIGINT << 32 | i) AS best FROM pairs WHERE made IS NOT NULL GROUP BY w
  ), places AS (
    SELECT p.w, p.i, p.j, p.made, p.joined
    FROM pairs p JOIN lowest o ON p.w = o.w AND p.made = o.best >> 32
    WHERE p.calm OR p.i = o.best & 4294967295
  ), numbered AS (
    SELECT *, row_number() OVER v AS n, i IS DISTINCT FROM lag(j) OVER v AS begins
    FROM places WINDOW v AS (PARTITION BY w ORDER BY i)
  ), hits AS (
    SELECT w, i, j, made, joined FROM (
      SELECT *, max(CASE WHEN begins THEN n END) OVER (PARTITION BY w ORDER BY i) AS first FROM numbered
    ) WHERE (n - first) % 2 = 0
  ), changes AS (
    SELECT w, i, made AS t, joined AS size FROM hits UNION ALL SELECT w, j, NULL, 0 FROM hits
  )
  SELECT p.w, p.i, CASE WHEN c.w IS NULL THEN p.t ELSE c.t END,
         CASE WHEN c.w IS NULL THEN p.size ELSE c.size END, p.step + 1
  FROM pairs p
  SEMI JOIN lowest o ON o.w = p.w
  LEFT JOIN changes c ON c.w = p.w AND c.i = p.i
  )
)
SELECT w, list(t ORDER BY i) AS ids FROM s WHERE t IS NOT NULL GROUP BY w ORDER BY w
"""

_DECODE = """
SELECT r.run, list(v.bytes ORDER BY r.place) AS pieces
FROM tokens r JOIN vocabulary v ON v.id = r.id GROUP BY r.run ORDER BY r.run
"""


class Ranks:
    """A rank file's vocabulary, its merge table in DuckDB, and the cutting of texts into words."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex

        with open(path, "rb") as file:
            lines = [line.split() for line in file if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.words = regex.compile(pattern)
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.begun = {token[:n] for token in self.ranks for n in range(1, len(token))}
        pairs = [
            (self.ranks[token[:n]], self.ranks[token[n:]], made)
            for token, made in self.ranks.items()
            for n in range(1, len(token))
            if token[:n] in self.ranks and token[n:] in self.ranks
        ]
        left, right, made = (np.array(x, np.int32) for x in zip(*pairs, strict=True))
        uneasy = np.concatenate([left[made < left], right[made < right]])
        merges = pa.table({"l": left, "r": right, "made": made, "calm": ~np.isin(made, uneasy)})  # noqa: F841
        known = pa.table({"id": pa.array(self.ranks.values(), pa.int32()), "bytes": pa.array(self.ranks, pa.binary())})  # noqa: F841
        self.base = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "temp_directory": ""})
        self.base.execute("CREATE TABLE merges AS SELECT * FROM merges")
        self.base.execute("CREATE TABLE vocabulary AS SELECT * FROM known")

    def parted(self, word: bytes) -> list[bytes]:
        """A long word in pieces: cut where no id of the vocabulary spans the place."""
        reach, cuts = 0, []
        for i in range(len(word)):
            if i and reach <= i:
                cuts.append(i)
            end = i + 1
            while end <= len(word):
                if word[i:end] in self.ranks:
                    reach = max(reach, end)
                if word[i:end] not in self.begun:
                    break
                end += 1
        return [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)], strict=True)]

    def merged(self, pieces: list[bytes], query: str) -> dict[bytes, bytes]:
        """Ids of distinct pieces as little-endian numbers, about ``BATCH`` bytes of pieces at a time."""
        found: dict[bytes, bytes] = {}
        held, size = [], 0
        for k, piece in enumerate(pieces):
            held.append(piece)
            size += len(piece)
            if size >= BATCH or k + 1 == len(pieces):
                lengths = np.array([len(p) for p in held], np.int64)
                place = np.arange(size) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                symbols = pa.table(
                    {
                        "w": np.repeat(np.arange(len(held), dtype=np.int32), lengths),
                        "i": place.astype(np.int32),
                        "t": self.of_byte[np.frombuffer(b"".join(held), np.uint8)],
                    }
                )
                self.base.register("symbols", symbols)
                got = self.base.sql(query).to_arrow_table().column("ids").combine_chunks()
                self.base.unregister("symbols")
                raw, ends = got.flatten().to_numpy().astype("<u4").tobytes(), (4 * np.cumsum(got.value_lengths())).tolist()
                found.update(zip(held, [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)], strict=True))
                held, size = [], 0
        return found

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of distinct words as little-endian numbers."""
        found = {w: self.ranks[w].to_bytes(4, "little") if w else b"" for w in words if not w or w in self.ranks}
        short = [w for w in words if len(w) <= CUT and w not in found]
        parts = {w: self.parted(w) for w in words if len(w) > CUT and w not in found}
        # of about equal length together, so that they end in about as many steps
        pieces = sorted({*short, *(p for own in parts.values() for p in own)}, key=len)
        longer = bisect.bisect_right(pieces, CUT, key=len)
        found |= self.merged(pieces[:longer], _ENCODE_SHORT) | self.merged(pieces[longer:], _ENCODE_LONG)
        found |= {w: b"".join([found[p] for p in own]) for w, own in parts.items()}
        return [found[w] for w in words]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts and the boundaries of the texts in them.

        The pattern begins a new word at every space behind no white space, so the
        ids of a text are those of its pieces in turn.
        """
        chunks = chunks_of(texts)
        strings = chunks.strings()
        store = kept_by("byte_pairs")
        pieces, words = (store.setdefault(name, Recent(KEPT)) for name in ("pieces", "words"))
        new = pieces.missing(strings)
        if new:
            split = [[w.encode() for w in self.words.findall(c)] for c in new]
            every = list(dict.fromkeys(w for own in split for w in own))
            unknown = words.missing(every)
            words.newer.update(zip(unknown, self.encode_words(unknown), strict=True))
            own_ids = dict(zip(every, words.values(every), strict=True))
            for c, own in zip(new, split, strict=True):
                pieces.newer[c] = b"".join([own_ids[w] for w in own])
        raw = pieces.values(strings)
        lengths = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
        begins = np.cumsum(lengths) - lengths
        ids = gather(np.frombuffer(b"".join(raw), "<u4"), begins[chunks.codes], lengths[chunks.codes])
        return ids, np.concatenate([[0], np.cumsum(sums(lengths[chunks.codes], chunks.starts))])

    def decode(self, ids: np.ndarray, starts: np.ndarray) -> list[bytes]:
        """Bytes of each text, from the ids alone."""
        sizes = np.diff(starts)
        runs = -(-sizes // RUN)
        begins = np.repeat(starts[:-1], runs) + RUN * (np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs))
        held = np.minimum(RUN, np.repeat(starts[1:], runs) - begins)
        tokens = pa.table(
            {
                "run": np.repeat(np.arange(len(held), dtype=np.int32), held),
                "place": np.arange(len(ids), dtype=np.int32),
                "id": ids.astype(np.int32),
            }
        )
        self.base.register("tokens", tokens)
        got = self.base.sql(_DECODE).to_arrow_table().column("pieces").combine_chunks()
        self.base.unregister("tokens")
        got = got.chunk(0) if isinstance(got, pa.ChunkedArray) else got
        pieces = got.values
        if len(pieces) != len(ids):
            raise ValueError("an id stands for no bytes")
        ends = np.frombuffer(pieces.buffers()[1], np.int32)[pieces.offset : pieces.offset + len(pieces) + 1]
        data = memoryview(pieces.buffers()[2] or b"")
        return [bytes(data[a:b]) for a, b in zip(ends[starts[:-1]].tolist(), ends[starts[1:]].tolist(), strict=True)]


@functools.lru_cache(maxsize=1)
def ranks_of(path: str, pattern: str) -> Ranks:
    return Ranks(path, pattern)


def _round_trip(batches: Iterable[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    model = ranks_of(path, pattern)
    for batch in slices(batches, limit=_SLICE):
        ids, starts = model.encode(batch.column(1))
        decoded = model.decode(ids, starts)
        raw, places = memoryview(ids.astype("<u4").tobytes()), (4 * starts).tolist()
        hashes = [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(places, places[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.diff(starts)), pa.array(hashes), pa.array([hashlib.sha256(d).hexdigest() for d in decoded])],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )


def _encode(batches: Iterable[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    model = ranks_of(path, pattern)
    for batch in slices(batches, limit=_SLICE):
        ids, starts = model.encode(batch.column(1))
        lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids.astype(np.int32)))
        yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["doc_id", "ids"])


def _decode(batches: Iterable[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    model = ranks_of(path, pattern)
    for batch in batches:
        lists = batch.column(1).fill_null([]) if batch.column(1).null_count else batch.column(1)
        starts = lists.offsets.to_numpy().astype(np.int64)
        ids = lists.values.to_numpy(zero_copy_only=False)[starts[0] : starts[-1]]
        decoded = model.decode(ids, starts - starts[0])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(decoded, pa.binary())], ["doc_id", "bytes"])


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, ids`` of every whole text; the pattern begins a word at each space behind no white space."""
    schema = "doc_id long, ids array<int>"
    return pick(docs, "doc_id", "text").mapInArrow(lambda batches: _encode(batches, path, pattern), schema)


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, bytes`` of the ids; null ids count as none, an id outside the vocabulary is an error."""
    schema = "doc_id long, bytes binary"
    return pick(encoded, "doc_id", "ids").mapInArrow(lambda batches: _decode(batches, path, pattern), schema)


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: every whole text encoded, and its ids decoded."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return pick(docs, "doc_id", "text").mapInArrow(lambda batches: _round_trip(batches, path, pattern), schema)
