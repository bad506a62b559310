"""Token ids as length-delimited binary records with an offset index (operator 1).

A shard is a file of frames ``length u64, masked crc of it u32, payload, masked
crc of it u32``, all little-endian. The checksum is CRC-32 as in zlib, rotated
and shifted by a constant so that checksums of data holding checksums stay
strong. The first frame of a shard is a JSON head with the bytes per id, every
other payload is ``null flag u8, doc_id i64, ids``. Documents are range-dealt by
doc_id, so shards and the records in them ascend; rows that share an id are
ordered by a hash of their text.

A task writes its shard under a name of its own and returns an index row per
record. The index is written by Spark, which keeps one attempt of each task, so
it names finished files only; files of lost attempts are never read.

Null texts count as empty (their record holds the end id alone), a null id sorts
first and stays null, repeated rows give repeated records, an empty table gives
an empty index. Texts are never cut.
"""

from __future__ import annotations

import itertools
import json
import os
import re
import string
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordmill.llm.shared import Recent, gather, kept_by, new_folder, pick, settle, slices, sums, words_of

#: Constant added to a rotated checksum.
MASK = 0xA282EAD8
#: Encoded pieces of words that a worker keeps, in each of two generations; bytes of text encoded at once.
KEPT_WORDS, _SLICE = 200_000, 2 << 20
#: Folded pieces that go to the library as one text.
_GROUP = 128
#: Words that can be folded, and the parts of a vocabulary file for which this holds.
_PLAIN = "^[!-~À-ÖØ-öø-ÿ]+$"
_NORMALIZER = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
}
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": _PATTERN}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
_LENGTH, _SUM, _HEAD = struct.Struct("<Q"), struct.Struct("<I"), struct.Struct("<?q")
_BLOCK = 8 << 20
INDEX = "doc_id long, shard int, path string, record long, offset long, length long, n_tokens long"


def masked(data: bytes) -> int:
    value = zlib.crc32(data)
    return ((value >> 15 | value << 17) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = _LENGTH.pack(len(payload))
    return b"".join((length, _SUM.pack(masked(length)), payload, _SUM.pack(masked(payload))))


def frame_length(head: bytes) -> int:
    """Payload length from the first 12 bytes of a frame."""
    (length,), (check,) = _LENGTH.unpack(head[:8]), _SUM.unpack(head[8:12])
    if masked(head[:8]) != check:
        raise ValueError("a record's length is damaged")
    return length


def payload_of(body: bytes, length: int) -> bytes:
    payload, (check,) = body[:length], _SUM.unpack(body[length : length + 4])
    if masked(payload) != check:
        raise ValueError("a record is damaged")
    return payload


class Encoder:
    """Ids of words as the tokenizers library gives them.

    Words of ASCII and Latin-1 letters are normalised here, all of a slice at once:
    NFC leaves them alone and lower case is character by character. The library
    gets them lower-cased, without its normalizer, and the marks behind a word
    apart from it, since its pattern never joins marks to a letter or a digit in
    front of them. All other words go through the whole library, one by one.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark keeps every core busy; threads on top only wait
        self.library = Tokenizer.from_file(path)
        size = self.library.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        end = content["model"].get("end_of_word_suffix") or ""
        names = [self.library.id_to_token(i) or "" for i in range(size)]
        #: Bytes of text behind an id.
        self.widths = np.array([len(x.removesuffix(end)) for x in names], np.int64)
        self.foldable = (content["normalizer"], content["pre_tokenizer"]) == (_NORMALIZER, _PRE_TOKENIZER)
        specials = [re.escape(t["content"]) for t in content.get("added_tokens", [])]
        #: Special strings in any case, as folding makes "<|X|>" the special "<|x|>", which the library does not.
        self.special = "|".join(specials) or None
        self.folded = Tokenizer.from_str(json.dumps(content | {"normalizer": None, "added_tokens": []}))

    @property
    def known(self) -> Recent:
        return kept_by("token_records").setdefault("words", Recent(KEPT_WORDS))

    def parts(self, vocabulary: pa.Array) -> tuple[pa.Array, pa.Array, np.ndarray, np.ndarray]:
        """Folded pieces, other words, and the places of each word's first and second piece among both.

        A folded word has a body and the marks behind it, either of which may be empty; another word is its own first piece.
        """
        plain = pc.match_substring_regex(vocabulary, _PLAIN) if self.foldable else pa.array(np.zeros(len(vocabulary), bool))
        if self.special and self.foldable:
            plain = pc.and_not(plain, pc.match_substring_regex(vocabulary, self.special, ignore_case=True))
        folds = plain.to_numpy(zero_copy_only=False)
        lowered = pc.utf8_lower(vocabulary.filter(plain))
        bodies = pc.ascii_rtrim(lowered, characters=string.punctuation)
        cut, whole = (pc.binary_length(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in (bodies, lowered))
        offsets, data = np.frombuffer(lowered.buffers()[1], np.int32), lowered.buffers()[2]
        begins = offsets[lowered.offset : lowered.offset + len(lowered)] + cut
        marks = gather(np.frombuffer(data or b"", np.uint8), begins, whole - cut)
        ends = np.concatenate([[0], np.cumsum(whole - cut)]).astype(np.int32)
        tails = pa.StringArray.from_buffers(len(lowered), pa.py_buffer(ends), pa.py_buffer(marks))
        coded = pa.concat_arrays([bodies, tails, pa.array([""])]).dictionary_encode()
        places, n = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(coded.dictionary)
        first, second = np.zeros(len(folds), np.int64), np.full(len(folds), places[-1])
        first[folds], second[folds] = places[: len(bodies)], places[len(bodies) : -1]
        first[~folds] = n + np.arange(len(folds) - len(bodies))
        return coded.dictionary, vocabulary.filter(pa.array(~folds)), first, second

    def ids(self, library, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in library.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, folded: list[str]) -> list[bytes]:
        """Ids of folded pieces, which go to the library many at a time; the bytes behind the ids part them again."""
        got = self.ids(self.folded, [" ".join(folded[k : k + _GROUP]) for k in range(0, len(folded), _GROUP)])
        sizes = np.fromiter(map(len, got), np.int64, len(got))
        lengths = pc.binary_length(pa.array(folded, pa.string())).to_numpy(zero_copy_only=False).astype(np.int64)
        ids = np.fromiter(itertools.chain.from_iterable(got), np.int64, int(sizes.sum()))
        if not len(ids):
            return [self.raw(x) for x in self.ids(self.folded, folded)]
        group, owner = np.arange(len(folded)) // _GROUP, np.repeat(np.arange(len(got)), sizes)
        widths = self.widths[ids]
        good = (sizes > 0) & (np.bincount(owner, widths, len(got)) == np.bincount(group, lengths, len(got)))
        # the groups in one row, those whose bytes don't add up without any
        reached, ends = np.cumsum(widths * good[owner]), np.cumsum(lengths * good[group])
        at = np.minimum(np.searchsorted(reached, ends), len(reached) - 1)
        good &= np.bincount(group, reached[at] != ends, len(got)) == 0
        begins = np.concatenate([[0], at[:-1] + 1])
        begins[::_GROUP] = np.cumsum(sizes) - sizes
        raw, size = ids.astype(self.dtype).tobytes(), self.dtype.itemsize
        found = [raw[begin:stop] for begin, stop in zip((begins * size).tolist(), ((at + 1) * size).tolist(), strict=True)]
        alone = np.flatnonzero(~good[group]).tolist()
        for k, own in zip(alone, self.ids(self.folded, [folded[k] for k in alone]), strict=True):
            found[k] = self.raw(own)
        return found

    def raw(self, ids: list[int]) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def looked_up(self, folded: list[str], others: list[str]) -> list[bytes]:
        """Ids of all pieces."""
        known = self.known
        known.newer[""] = b""
        new = known.missing(folded)
        known.newer.update(zip(new, self.learn(new), strict=True))
        new = known.missing(others)
        known.newer.update(zip(new, map(self.raw, self.ids(self.library, new)), strict=True))
        return known.values(folded + others)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts and the boundaries of the texts in them.

        White space parts words in this vocabulary's pre-tokenizer, so a text's
        ids are those of its words in turn.
        """
        words = words_of(texts)
        if not len(words.codes):
            return np.zeros(0, self.dtype), np.zeros(len(words.starts), np.int64)
        folded, others, first, second = self.parts(words.vocabulary)
        raw = self.looked_up(*(x.to_numpy(zero_copy_only=False).tolist() for x in (folded, others)))
        each = np.fromiter(map(len, raw), np.int64, len(raw)) // self.dtype.itemsize
        begins = np.cumsum(each) - each
        pairs = np.column_stack([first, second]).ravel()
        flat = gather(np.frombuffer(b"".join(raw), self.dtype), begins[pairs], each[pairs])
        lengths = each[first] + each[second]
        begins = np.cumsum(lengths) - lengths
        ids = gather(flat, begins[words.codes], lengths[words.codes])
        return ids, np.concatenate([[0], np.cumsum(sums(lengths[words.codes], words.starts))])


def encoder(path: str) -> Encoder:
    """The worker's encoder of a vocabulary, dropped with what else this operator keeps."""
    kept = kept_by("token_records")
    if kept.get("path") != path:
        kept.clear()
        kept.update(path=path, encoder=Encoder(path))
    return kept["encoder"]


def open_folder(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def _write(batches: Iterable[pa.RecordBatch], vocabulary: str, folder: str, end_id: int) -> Iterator[pa.RecordBatch]:
    model, shard = encoder(vocabulary), TaskContext.get().partitionId()
    system, root = open_folder(folder)
    system.create_dir(root, recursive=True)
    name = f"shard-{shard:06d}-{uuid.uuid4().hex}.records"
    end = np.array([end_id], model.dtype).tobytes()
    at, record, out = 0, 0, None
    try:
        for batch in slices(batches, limit=_SLICE):
            if out is None:
                out = system.open_output_stream(f"{root}/{name}")
                head = frame(json.dumps({"version": 1, "id_bytes": model.dtype.itemsize}).encode())
                out.write(head)
                at = len(head)
            ids, starts = model.encode(batch.column(1))
            frames, rows = [], []
            for i, doc_id in enumerate(batch.column(0).to_pylist()):
                own = ids[starts[i] : starts[i + 1]].tobytes() + end
                framed = frame(_HEAD.pack(doc_id is None, doc_id or 0) + own)
                frames.append(framed)
                rows.append((doc_id, shard, f"{folder}/{name}", record, at, len(framed), len(own) // model.dtype.itemsize))
                at, record = at + len(framed), record + 1
            out.write(b"".join(frames))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _INDEX_TYPES, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in INDEX.split(", ")])
    finally:
        if out is not None:
            out.close()


def write_records(docs: DataFrame, vocabulary: str, folder: str, end_id: int = 1, shards: int | None = None) -> DataFrame:
    """Write the shards and their index under ``folder``; gives the index."""
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))

    tie = F.xxhash64("text")
    dealt = pick(docs, "doc_id", "text").repartitionByRange(shards, "doc_id", tie).sortWithinPartitions("doc_id", tie)
    return settle(dealt.mapInArrow(lambda batches: _write(batches, vocabulary, folder, end_id), INDEX))


_INDEX_TYPES = [pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]


def parsed(payload: bytes, id_bytes: int) -> tuple[int | None, np.ndarray]:
    null, doc_id = _HEAD.unpack_from(payload)
    return None if null else doc_id, np.frombuffer(payload, f"<u{id_bytes}", offset=_HEAD.size)


def records_of(system, path: str) -> Iterator[tuple[int | None, np.ndarray]]:
    """All records of a shard in turn, read in blocks."""
    with system.open_input_stream(path, buffer_size=_BLOCK) as file:
        id_bytes = None
        while head := file.read(12):
            length = frame_length(head)
            payload = payload_of(file.read(length + 4), length)
            if id_bytes is None:
                id_bytes = json.loads(payload)["id_bytes"]
            else:
                yield parsed(payload, id_bytes)


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            system, path = open_folder(row["path"])
            start, found, got = row["start"], 0, []
            for doc_id, ids in records_of(system, path):
                got.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                start, found = start + len(ids), found + 1
                if len(got) == 10_000:
                    yield _table(got)
                    got = []
            if found != row["rows"]:
                raise ValueError(f"{path} holds {found} records, its index {row['rows']}")
            if got:
                yield _table(got)


def read_records(index: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` from the files, a task per shard.

    ``start`` is the number of ids before the record in the whole order. The
    running sum goes over one row per shard.
    """
    shards = index.groupBy("shard", "path").agg(F.sum("n_tokens").alias("total"), F.count(F.lit(1)).alias("rows"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    begun = shards.withColumn("start", F.coalesce(F.sum("total").over(earlier), F.lit(0)))
    n = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    placed = begun.select("shard", "path", "start", "rows").repartitionByRange(n, "shard")
    return placed.mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _table(rows: list[tuple]) -> pa.RecordBatch:
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names)


def _fetch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, rows in _by_path(batch).items():
            system, place = open_folder(path)
            with system.open_input_file(place) as file:
                length = frame_length(file.read_at(12, 0))
                id_bytes = json.loads(payload_of(file.read_at(length + 4, 12), length))["id_bytes"]
                got = []
                for offset, size in rows:
                    raw = file.read_at(size, offset)
                    got.append(parsed(payload_of(raw[12:], frame_length(raw)), id_bytes))
            ids = pa.array([x.astype(np.int64) for _, x in got], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in got], pa.int64()), ids], ["doc_id", "ids"])


def fetch_records(index: DataFrame) -> DataFrame:
    """``doc_id, ids`` of index rows in any order, each read at its own offset."""

    return index.select("path", "offset", "length").mapInArrow(_fetch, "doc_id long, ids array<long>")


def _by_path(batch: pa.RecordBatch) -> dict[str, list[tuple[int, int]]]:
    found: dict[str, list[tuple[int, int]]] = {}
    for row in batch.to_pylist():
        found.setdefault(row["path"], []).append((row["offset"], row["length"]))
    return found


def token_records(docs: DataFrame, vocabulary: str, end_id: int = 1, shards: int | None = None) -> DataFrame:
    """Write the records to a new folder beside the checkpoints and read them back."""
    folder = f"{new_folder(docs.sparkSession)}/records"
    return read_records(write_records(docs, vocabulary, folder, end_id, shards))
