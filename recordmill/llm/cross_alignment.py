"""Alignment of two tokenizers over byte ranges, with corpus counts by external spills (operator 12).

Every text is encoded by a byte-level vocabulary (A, of the tokenizers library) and by a
piece vocabulary (B, of sentencepiece, which puts the space in front). Places where tokens
of both end cut the tokens into groups; tokens of A and B whose byte ranges overlap are
linked, one link for each stretch between neighbouring token ends.

Both vocabularies end a token at each space behind no white space, so texts are cut there.
A worker keeps the alignment of the pieces it met lately, up to ``KEPT`` of them in two
generations. A text with a piece that its tokens do not give back is judged as a whole; if
its tokens do not give it back either, it has none.

Counting is external. A slice of texts makes records ``pair, document, times``, sorted by
pair with the B id first, dealt to ``radix`` partitions by B id and packed as zstd runs,
which Spark writes and shuffles. The runs of a split (``SLICES`` slices) and radix are
merged with a heap of their frames: once to count the pairs of the split, and once more,
beside the corpus-wide counts and each B id's highest one in the same order, to give every
document its share. Only sums per split and pair cross splits, so that a B id of every
document is not gathered in one task; nothing held at once grows with the corpus.

Null and empty texts, and texts that their tokens do not give back, have no tokens: zeros
and the group hash ''. Special strings inside texts are plain text. A null id stays null,
rows are judged and counted one by one also if they repeat an id, an empty table gives
none, further columns are ignored whatever their names. Texts are never cut short.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import itertools
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordmill.llm.shared import Recent, chunks_of, gather, kept_by, mixed, owners, pick, settle, slices, sums

KEPT = 150_000
RADIX = 8
#: Slices of a split, records of a frame.
SLICES, FRAME = 32, 1 << 16
_SLICE = 4 << 20
_BATCH = 50_000
#: Bits of a document's number in its split; a pair has the others.
_DOCUMENT = 28
_HEAD = struct.Struct("<III")
_SHIFT, _LOW = np.uint64(_DOCUMENT), np.uint64((1 << _DOCUMENT) - 1)
Frame = tuple[np.ndarray, np.ndarray, np.ndarray]


def byte_characters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones themselves, others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def piece_bytes(piece: str) -> bytes:
    """Bytes of a piece: ``<0xHH>`` is one byte, U+2581 a space."""
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


class Side:
    """Bytes of each id, and its decimal with each of two marks behind it."""

    def __init__(self, tokens: list[bytes], last: str):
        self.data, self.begins, self.lengths = self._flat(tokens)
        names = [f"{i}{mark}".encode() for mark in (",", last) for i in range(len(tokens))]
        self.names, self.name_begins, self.name_lengths = self._flat(names)
        self.size = len(tokens)

    @staticmethod
    def _flat(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lengths = np.array([len(p) for p in parts], np.int64)
        return np.frombuffer(b"".join(parts), np.uint8), np.cumsum(lengths) - lengths, lengths

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        return gather(self.data, self.begins[ids], self.lengths[ids])


#: Numbers of a piece: ids of A, ids of B, groups, links.
_NUMBERS = np.dtype("<u4")
_NOTHING = (b"\0" * 16, b"", b"")
Piece = tuple[bytes, bytes, bytes]


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_file(path_a)
        self.first.encode_special_tokens = True
        self.second = sentencepiece.SentencePieceProcessor(model_file=path_b)
        of, size = byte_characters(), self.first.get_vocab_size(with_added_tokens=True)
        names = [self.first.id_to_token(i) or "" for i in range(size)]
        self.a = Side([bytes(map(of.__getitem__, n)) if all(c in of for c in n) else n.encode() for n in names], "|")
        pieces = [self.second.id_to_piece(i) for i in range(self.second.get_piece_size())]
        self.b = Side([piece_bytes(p) for p in pieces], ";")
        if self.a.size * self.b.size >= 1 << 64 - _DOCUMENT:
            raise ValueError("the vocabularies are too large for one number of a pair")

    def aligned(self, texts: list[str]) -> list[Piece | None]:
        """``numbers, pairs, groups`` as bytes, of texts that begin with a space.

        A pair is ``id of B * size of A + id of A``; the groups' text ends with ';'.
        None for a text that its tokens do not give back; '' has no tokens.
        """
        ids_a = [x.ids for x in self.first.encode_batch_fast(texts, add_special_tokens=False)]
        ids_b = self.second.encode([t[1:] for t in texts], num_threads=1)
        raw = [t.encode() for t in texts]
        data = np.frombuffer(b"".join(raw), np.uint8)
        n_a, n_b = (np.fromiter(map(len, ids), np.int64, len(ids)) for ids in (ids_a, ids_b))
        flat_a, flat_b = (
            np.fromiter(itertools.chain.from_iterable(ids), np.int64, int(n.sum())) for ids, n in ((ids_a, n_a), (ids_b, n_b))
        )
        if not (np.array_equal(self.a.bytes_of(flat_a), data) and np.array_equal(self.b.bytes_of(flat_b), data)):
            if len(texts) == 1:
                return [None]
            half = len(texts) // 2
            return self.aligned(texts[:half]) + self.aligned(texts[half:])
        ends_a, ends_b = np.cumsum(self.a.lengths[flat_a]), np.cumsum(self.b.lengths[flat_b])
        ending = np.zeros(len(data) + 1, np.uint8)  # by byte: 1 where a token of A ends, 2 of B, 3 of both
        ending[ends_a] = 1
        ending[ends_b] += 2
        of_a, of_b = np.cumsum(ending & 1, dtype=np.int64), np.cumsum(ending >> 1, dtype=np.int64)
        ends, cuts = np.flatnonzero(ending), np.flatnonzero(ending == 3)
        before = ending[ends].astype(np.int64)
        pairs = flat_b[of_b[ends] - (before >> 1)] * self.a.size + flat_a[of_a[ends] - (before & 1)]
        text_ends = np.cumsum([len(r) for r in raw])
        groups, links = (np.searchsorted(x, text_ends, side="right") for x in (cuts, ends))
        # tokens in the order of the groups' text, those of A before those of B, the last of each with another mark
        tokens, places = [], []
        for side, flat, upto, shift in ((self.a, flat_a, of_a[cuts], 0), (self.b, flat_b, of_b[cuts], 1)):
            last = np.zeros(len(flat), np.int64)
            last[upto - 1] = side.size
            group = np.repeat(np.arange(len(upto)), np.diff(upto, prepend=0))
            tokens.append((flat + last, side.name_lengths[flat + last]))
            places.append(2 * group + shift)
        order = np.argsort(np.concatenate(places), kind="stable")
        names = np.concatenate([self.a.names, self.b.names])
        begins = np.concatenate([self.a.name_begins[tokens[0][0]], len(self.a.names) + self.b.name_begins[tokens[1][0]]])[order]
        sizes = np.concatenate([tokens[0][1], tokens[1][1]])[order]
        written = gather(names, begins, sizes).tobytes()
        counts = np.diff(np.stack([groups, links]), axis=1, prepend=0)
        numbers = np.stack([n_a, n_b, *counts], axis=1).astype(_NUMBERS).tobytes()
        packed = pairs.astype("<u8").tobytes()
        text_at = np.append(0, np.cumsum(sizes))[np.cumsum(n_a + n_b)].tolist()
        link = (8 * links).tolist()
        return [
            (numbers[16 * k : 16 * k + 16], packed[l0:l1], written[t0:t1])
            for k, (l0, l1, t0, t1) in enumerate(zip([0, *link], link, [0, *text_at], text_at, strict=False))
        ]

    def pieces(self, texts: pa.Array) -> tuple[list[Piece], np.ndarray, np.ndarray]:
        """Aligned pieces, and which of them follow each other in each text."""
        spaced = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", pc.binary_join_element_wise(" ", texts, ""))
        chunks = chunks_of(spaced)
        strings, codes, starts = chunks.strings(), chunks.codes, chunks.starts
        known = kept_by("cross_alignment").setdefault("pieces", Recent(KEPT))
        new = known.missing(strings)
        for k in range(0, len(new), _BATCH):
            known.newer.update(zip(new[k : k + _BATCH], self.aligned(new[k : k + _BATCH]), strict=True))
        found = known.values(strings)
        lost = np.fromiter((x is None for x in found), bool, len(found))
        if lost.any():
            own = owners(starts)
            whole = np.unique(own[lost[codes]])
            codes = codes[~np.isin(own, whole)]
            sizes = np.diff(starts)
            sizes[whole] = 0
            at = np.cumsum(sizes) - sizes
            codes = np.insert(codes, at[whole], len(found) + np.arange(len(whole)))
            sizes[whole] = 1
            starts = np.concatenate([[0], np.cumsum(sizes)])
            found += [self.aligned([spaced[i].as_py()])[0] for i in whole.tolist()]
        return [x or _NOTHING for x in found], codes, starts


@functools.lru_cache(maxsize=1)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def packed(pairs: np.ndarray, documents: np.ndarray, times: np.ndarray) -> bytes:
    """A run: frames of at most ``FRAME`` records in order of pair, each frame with its pairs once."""
    import zstandard

    zip_, parts = zstandard.ZstdCompressor(level=1), []
    for k in range(0, len(pairs), FRAME):
        own = pairs[k : k + FRAME]
        heads = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        counts = np.diff(np.append(heads, len(own))).astype("<u4")
        columns = (own[heads].astype("<u8"), counts, documents[k : k + FRAME].astype("<u4"), times[k : k + FRAME].astype("<u4"))
        body = zip_.compress(b"".join(c.tobytes() for c in columns))
        parts += [_HEAD.pack(len(heads), len(own), len(body)), body]
    return b"".join(parts)


def frames(run: bytes) -> Iterator[Frame]:
    import zstandard

    unzip, at = zstandard.ZstdDecompressor(), 0
    while at < len(run):
        n, records, size = _HEAD.unpack_from(run, at)
        at += _HEAD.size
        body = unzip.decompress(run[at : at + size], max_output_size=12 * n + 8 * records)
        at += size
        counts = np.frombuffer(body, "<u4", n, 8 * n)
        pairs = np.repeat(np.frombuffer(body, "<u8", n), counts)
        yield pairs, np.frombuffer(body, "<u4", records, 12 * n), np.frombuffer(body, "<u4", records, 12 * n + 4 * records)


def merged(runs: list[bytes]) -> Iterator[Frame]:
    """Records of all runs in order of pair. A heap tells which run's frame ends first; up to there all are taken."""
    sources, held, heap = [frames(r) for r in runs], {}, []

    def load(k: int) -> None:
        frame = next(sources[k], None)
        held.pop(k, None)
        if frame is not None:
            held[k] = frame
            heapq.heappush(heap, (int(frame[0][-1]), k))

    for k in range(len(runs)):
        load(k)
    while heap:
        bound, _ = heap[0]
        taken = []
        for k, frame in held.items():
            upto = int(np.searchsorted(frame[0], np.uint64(bound), side="right"))
            if upto:
                taken.append([column[:upto] for column in frame])
                held[k] = tuple(column[upto:] for column in frame)
        ended = []
        while heap and heap[0][0] == bound:
            ended.append(heapq.heappop(heap)[1])
        for k in ended:  # a next frame may begin with the same pair
            load(k)
        pairs, documents, times = (np.concatenate(x) for x in zip(*taken, strict=True))
        order = np.argsort(pairs, kind="stable")
        yield pairs[order], documents[order], times[order]


_MADE = (
    "split long, radix int, run binary, document long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
)
_NAMES = [c.split()[0] for c in _MADE.split(", ")]
_TYPES = [pa.int64(), pa.int32(), pa.binary(), *[pa.int64()] * 6, pa.string()]


def _row(n: int, **columns) -> pa.RecordBatch:
    arrays = [pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in zip(_NAMES, _TYPES, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, _NAMES)


def _texts(found: list[Piece], codes: np.ndarray, starts: np.ndarray) -> Iterator[bytes]:
    """The groups' text of each document."""
    written, places = [x[2] for x in found], starts.tolist()
    for a, b in zip(places, places[1:], strict=False):
        yield b"".join([written[c] for c in codes[a:b].tolist()])[:-1]


def _encode(batches: Iterable[pa.RecordBatch], path_a: str, path_b: str, radix: int) -> Iterator[pa.RecordBatch]:
    model, task, begun = aligner(path_a, path_b), TaskContext.get().partitionId(), 0
    for k, batch in enumerate(slices(batches, limit=_SLICE)):
        split = task << 32 | k // SLICES
        begun = begun if k % SLICES else 0
        found, codes, starts = model.pieces(batch.column(1))
        number = np.frombuffer(b"".join([x[0] for x in found]), _NUMBERS).reshape(-1, 4).T.astype(np.int64)
        n_a, n_b, n_groups, n_links = (sums(x[codes], starts) for x in number)
        hashes = [hashlib.sha256(t).hexdigest() if t else "" for t in _texts(found, codes, starts)]
        documents = begun + np.arange(batch.num_rows)
        if documents[-1] >> _DOCUMENT:
            raise ValueError("a split has too many documents")
        yield _row(
            batch.num_rows, split=np.full(batch.num_rows, split), document=documents, doc_id=batch.column(0),
            n_a=n_a, n_b=n_b, n_groups=n_groups, n_links=n_links, groups_sha256=hashes,
        )
        lengths = number[3]
        pairs = np.frombuffer(b"".join([x[1] for x in found]), "<u8")
        linked = gather(pairs << _SHIFT, (np.cumsum(lengths) - lengths)[codes], lengths[codes])
        linked |= np.repeat(documents, n_links).astype(np.uint64)
        linked.sort()
        heads = np.flatnonzero(np.append(True, linked[1:] != linked[:-1])) if len(linked) else np.zeros(0, np.int64)
        times, linked = np.diff(np.append(heads, len(linked))), linked[heads]
        pairs, documents = linked >> _SHIFT, linked & _LOW
        of = (mixed(pairs // np.uint64(model.a.size)) % np.uint64(radix)).astype(np.uint16)
        order = np.argsort(of, kind="stable")
        ends = np.cumsum(np.bincount(of, minlength=radix)).tolist()
        runs = [(r, order[a:b]) for r, (a, b) in enumerate(zip([0, *ends], ends, strict=False)) if b > a]
        blobs = [packed(pairs[own], documents[own], times[own]) for _, own in runs]
        if runs:
            yield _row(len(runs), split=np.full(len(runs), split), radix=[r for r, _ in runs], run=blobs)
        begun += batch.num_rows


def encoded(docs: DataFrame, path_a: str, path_b: str, radix: int = RADIX) -> DataFrame:
    """A settled table with a row per document, and the runs of each split and radix."""
    return settle(pick(docs, "doc_id", "text").mapInArrow(lambda batches: _encode(batches, path_a, path_b, radix), _MADE))


_COUNTED = "split long, radix int, pair long, n long"


def _count(key: tuple, table: pa.Table) -> pa.Table:
    pairs, totals = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for own, _, times in merged(table.column("run").to_pylist()):
        heads = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        total = np.add.reduceat(times.astype(np.int64), heads)
        if len(pairs[-1]) and pairs[-1][-1] == own[0]:  # a pair that goes on behind a frame's end
            totals[-1][-1] += total[0]
            heads, total = heads[1:], total[1:]
            if not len(heads):
                continue
        pairs.append(own[heads])
        totals.append(total)
    found, n = np.concatenate(pairs), np.concatenate(totals)
    return pa.table(
        {
            "split": np.full(len(found), key[0].as_py()),
            "radix": np.full(len(found), key[1].as_py(), np.int32),
            "pair": found.astype(np.int64),
            "n": n,
        }
    )


def counted(made: DataFrame) -> DataFrame:
    """``split, radix, pair, n``: links of each pair in each split."""
    runs = made.where("radix IS NOT NULL").select("split", "radix", "run")
    return settle(runs.groupBy("split", "radix").applyInArrow(_count, _COUNTED))


def totals(counts: DataFrame, size_a: int) -> DataFrame:
    """``pair, count, best``: corpus-wide links of a pair, and whether no other pair of its B id has more.

    The highest counts are a row per B id, that is at most the size of that vocabulary, and so are broadcast.
    """
    found = counts.groupBy("pair").agg(F.sum("n").alias("count")).withColumn("b", F.expr(f"pair div {size_a}"))
    highest = found.groupBy("b").agg(F.max("count").alias("highest"))
    return found.join(F.broadcast(highest), "b").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


_SHARE = "split long, document long, n_best long, count_sum long"


def _share(key: tuple, runs: pa.Table, counts: pa.Table) -> pa.Table:
    """Counts of the split's pairs in the order of the merged runs, given back to its documents."""
    pairs = counts.column("pair").to_numpy().astype(np.uint64)
    order = np.argsort(pairs)
    pairs, count = pairs[order], counts.column("count").to_numpy()[order]
    best = counts.column("best").to_numpy().astype(np.int64)[order]
    sum_, n_best, at = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    for own, documents, times in merged(runs.column("run").to_pylist()):
        upto = int(np.searchsorted(pairs, own[-1], side="right"))
        place = at + np.searchsorted(pairs[at:upto], own)
        at = upto - 1  # the last pair may go on
        more = int(documents.max()) + 1 - len(sum_)
        if more > 0:
            sum_, n_best = (np.concatenate([x, np.zeros(more, np.int64)]) for x in (sum_, n_best))
        np.add.at(sum_, documents, times * count[place])
        np.add.at(n_best, documents, times * best[place])
    found = np.flatnonzero(sum_)
    return pa.table(
        {"split": np.full(len(found), key[0].as_py()), "document": found, "n_best": n_best[found], "count_sum": sum_[found]}
    )


def cross_alignment(docs: DataFrame, path_a: str, path_b: str, radix: int = RADIX) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every whole text.

    ``n_best`` are links whose pair is its B id's most frequent one, ``count_sum`` adds the corpus-wide
    counts of all links, the hash is of the groups as ``a1,a2|b1;a3|b2,b3``.
    """
    made = encoded(docs, path_a, path_b, radix)
    counts = counted(made)
    found = totals(counts, aligner(path_a, path_b).a.size)
    marks = counts.select("split", "radix", "pair").join(found, "pair").select("split", "radix", "pair", "count", "best")
    runs = made.where("radix IS NOT NULL").select("split", "radix", "run")
    shares = runs.groupBy("split", "radix").cogroup(marks.groupBy("split", "radix")).applyInArrow(_share, _SHARE)
    shares = shares.groupBy("split", "document").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    rows = made.where("radix IS NULL").drop("radix", "run")
    zero = F.lit(0).cast("long")
    return rows.join(shares, ["split", "document"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256",
    )


def pair_counts(docs: DataFrame, path_a: str, path_b: str, radix: int = RADIX) -> DataFrame:
    """``b, a, count, best`` of every linked pair of ids."""
    size = aligner(path_a, path_b).a.size
    found = totals(counted(encoded(docs, path_a, path_b, radix)), size)
    return found.select(F.expr(f"pair div {size}").alias("b"), F.expr(f"pair % {size}").alias("a"), "count", "best")


def _groups(batches: Iterable[pa.RecordBatch], path_a: str, path_b: str) -> Iterator[pa.RecordBatch]:
    model = aligner(path_a, path_b)
    for batch in slices(batches, limit=_SLICE):
        own = [t.decode() for t in _texts(*model.pieces(batch.column(1)))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.string())], ["doc_id", "groups"])


def groups(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``doc_id, groups``: the groups of every whole text as ``a1,a2|b1;a3|b2,b3``, '' without tokens."""
    return pick(docs, "doc_id", "text").mapInArrow(lambda batches: _groups(batches, path_a, path_b), "doc_id long, groups string")
