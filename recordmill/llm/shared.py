"""What the operators share: column picking, settled tables, words as Arrow arrays."""

from __future__ import annotations

import ctypes
import gc
import itertools
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.session import shared_folder, to_release

#: Columns of the documents table.
DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")
#: Set while a table is settled: shuffle files go with the query, Python gets small batches of long texts.
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_WHILE_SETTLING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", _BATCH: "1000"}


def pick(df: DataFrame, *names: str, **renamed: str) -> DataFrame:
    """The columns with exactly these names (``renamed``: new name = old name).

    Columns are taken by position, so further columns may clash with them, also
    in everything but case; of columns with the same name the first counts. Where
    texts are among them, the session's Arrow batches are held to 1,000 rows.
    """
    have = df.columns
    if "text" in names and int(df.sparkSession.conf.get(_BATCH)) > 1000:
        df.sparkSession.conf.set(_BATCH, "1000")
    plain = df.toDF(*[f"c{i}" for i in range(len(have))])
    wanted = {n: n for n in names} | renamed
    return plain.select(*[F.col(f"c{have.index(old)}").alias(new) for new, old in wanted.items()])


def new_folder(spark: SparkSession) -> str:
    """A folder name of its own, which ``recordmill.session.release`` deletes."""
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    to_release(path)
    return path


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and go on from there.

    A lost executor then costs no more than reading again, and the shuffle files
    behind the table are removed as soon as it is written.
    """
    spark = df.sparkSession
    path, before = new_folder(spark), {key: spark.conf.get(key) for key in _WHILE_SETTLING}
    for key, value in _WHILE_SETTLING.items():
        spark.conf.set(key, value)
    try:
        df.write.parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(path)


def hinted(settled: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """The settled table of a few numbers a row, with a broadcast hint if it has at most ``rows`` rows.

    The count comes from the files' footers. Beyond it the join shuffles.
    """
    return F.broadcast(settled) if settled.count() <= rows else settled


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The rows in pieces of about ``limit`` bytes of text, a row at least; nulls read as ''.

    Small batches are put together, large ones are cut.
    """
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if batch.num_rows:
            at = batch.schema.get_field_index(column)
            texts = pc.fill_null(batch.column(at), "")
            held.append(batch.set_column(at, pa.field(column, texts.type), texts))
            size += int(pc.sum(pc.binary_length(texts)).as_py())
        if size >= limit:
            yield from _cut(held, column, limit)
            held, size = [], 0
    if held:
        yield from _cut(held, column, limit)


def _cut(held: list[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    whole = held if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()
    for batch in whole:
        sizes = pc.binary_length(batch.column(batch.schema.get_field_index(column)))
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        begin = 0
        while begin < batch.num_rows:
            done = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end


#: What operators keep between the batches of a worker, by operator.
KEPT: dict[str, dict] = {}


def kept_by(operator: str) -> dict:
    """The operator's own store; what others left in a reused worker is dropped and its memory given back."""
    others = [name for name in KEPT if name != operator]
    for other in others:
        del KEPT[other]
    if others:
        give_back()
    return KEPT.setdefault(operator, {})


def give_back() -> None:
    """Return what this worker has freed to the system; Python, Arrow and the C library would hold much of it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only in glibc
    if trim is not None:
        trim(0)


class Recent:
    """Values of keys met lately, in two generations: when the newer is full, the older is dropped."""

    def __init__(self, limit: int):
        self.limit, self.newer, self.older = limit, {}, {}

    def missing(self, keys: list) -> list:
        """Keys without a value; the others are held in the newer generation from now on."""
        newer, older, found = self.newer, self.older, []
        for key in itertools.filterfalse(newer.__contains__, keys):
            if key in older:
                newer[key] = older[key]
            else:
                found.append(key)
        return found

    def values(self, keys: list) -> list:
        """Values of keys that ``missing`` was asked for and that were put since; may start a new generation."""
        found = list(map(self.newer.__getitem__, keys))
        if len(self.newer) > self.limit:
            self.older, self.newer = self.newer, {}
        return found


@dataclass
class Words:
    """Words of several texts: ``codes`` into ``vocabulary``; text i has codes[starts[i]:starts[i + 1]]."""

    codes: np.ndarray
    starts: np.ndarray
    vocabulary: pa.Array

    def strings(self) -> list[str]:
        return self.vocabulary.to_numpy(zero_copy_only=False).tolist()


def words_of(texts: pa.Array) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text, unchanged; null has none."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    offsets = lists.offsets.to_numpy().astype(np.int64)
    coded = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    codes, starts = coded.indices.to_numpy(zero_copy_only=False), offsets - offsets[0]
    blank = pc.index(coded.dictionary, "").as_py()
    if blank >= 0:  # white space at an end of a text
        kept = codes != blank
        starts = np.concatenate([[0], np.cumsum(kept)])[starts]
        codes = codes[kept]
    return Words(codes, starts, coded.dictionary)


#: Characters that any of the tokenizers takes for white space, at the end of a text.
_WHITE_END = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]$"


def chunks_of(texts: pa.Array) -> Words:
    """Pieces of texts that follow each other without a gap: a new one begins at each space behind no white space.

    A space at the very end of a text stays with what is before it. Texts are not null; '' has one empty piece.
    """
    if not len(texts):
        return Words(np.zeros(0, np.int64), np.zeros(1, np.int64), pa.array([], pa.string()))
    lists = pc.split_pattern(texts, " ")
    offsets = lists.offsets.to_numpy().astype(np.int64)
    coded = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    codes, starts = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), offsets - offsets[0]
    parts, n = coded.dictionary, len(coded.dictionary)
    empty = pc.equal(pc.binary_length(parts), 0).to_numpy(zero_copy_only=False)
    open_end = empty | pc.match_substring_regex(parts, _WHITE_END).to_numpy(zero_copy_only=False)
    glued = np.append(False, open_end[codes[:-1]])
    ends = starts[1:] - 1
    glued[ends] |= empty[codes[ends]]
    glued[starts[:-1]] = False
    first = np.zeros(len(codes), bool)
    first[starts[:-1]] = True
    heads = np.flatnonzero(~glued)
    sizes = np.diff(np.append(heads, len(codes)))
    found = np.where(first[heads], codes[heads] + n, codes[heads])
    extra: dict[str, int] = {}
    for k in np.flatnonzero(sizes > 1).tolist():
        at = int(heads[k])
        joined = " ".join(parts.take(pa.array(codes[at : at + int(sizes[k])])).to_pylist())
        found[k] = extra.setdefault(joined if first[at] else f" {joined}", 2 * n + len(extra))
    used = np.zeros(2 * n + len(extra), bool)
    used[found] = True
    every = pa.chunked_array([pc.binary_join_element_wise(" ", parts, ""), parts, pa.array(list(extra), pa.string())])
    vocabulary = every.filter(pa.array(used)).combine_chunks()
    return Words((np.cumsum(used) - 1)[found], np.searchsorted(heads, starts), vocabulary)


def sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum per text of an integer per word."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[starts[1:]] - total[starts[:-1]]


def owners(starts: np.ndarray) -> np.ndarray:
    """The text that each word belongs to."""
    return np.repeat(np.arange(len(starts) - 1), np.diff(starts))


def gather(values: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """values[b:b + n] of each pair, one behind the other."""
    if not len(begins):
        return values[:0]
    shift = np.repeat(begins - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
    return values[np.arange(len(shift)) + shift]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def shingle_hashes(words: np.ndarray, starts: np.ndarray, size: int, whole: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` consecutive words within a text, with the boundaries of the texts.

    With ``whole`` a text of fewer words has its whole sequence as the one shingle.
    """
    counts = np.diff(starts)
    number = np.maximum(counts - size + 1, 0)
    total = int(number.sum())
    ends = np.concatenate([[0], np.cumsum(number)])
    first = np.arange(total) + np.repeat(starts[:-1] - ends[:-1], number)
    found = np.zeros(total, np.uint64)
    base = np.uint64(0x9E3779B97F4A7C15)
    for k in range(size):
        found = found * base + words[first + k]
    found = mixed(found)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if not whole or not len(short):
        return found, ends
    extra = np.zeros(len(short), np.uint64)
    for k in range(size - 1):
        has = counts[short] > k
        extra[has] = extra[has] * base + words[starts[short[has]] + k]
    extra = mixed(extra + counts[short].astype(np.uint64))
    number[short] = 1
    return np.insert(found, ends[short], extra), np.concatenate([[0], np.cumsum(number)])


_BASE = 0x9E3779B97F4A7C15
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}
#: Bytes of text hashed at once; a worker keeps as many powers.
_BLOCK = 1 << 19


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64; at least ``n`` of each."""
    if len(_POWERS["up"]) < n:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            row = np.full(n, base, np.uint64)
            row[0] = 1
            _POWERS[name] = np.cumprod(row, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def _tables() -> tuple[np.ndarray, np.ndarray]:
    plain = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
    lower = plain.copy()
    lower[65:91] = plain[97:123]
    return plain, lower


_PLAIN, _LOWER = _tables()
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_MARKS = np.zeros(256, bool)
_MARKS[[c for c in range(128) if not chr(c).isalnum()]] = True


def hashed_words(texts: pa.Array, lower: bool = False, bare: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` of each text and the boundaries of the texts.

    Runs on the bytes of the whole column: a running sum of byte values times
    powers of a base, of which a word takes the difference. ``lower`` folds A-Z,
    ``bare`` parts words at every ASCII character but letters and digits.
    """
    texts = pc.fill_null(texts, "")
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if offsets[0] == offsets[-1]:
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    word = ~(_MARKS if bare else _SPACE)[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins = np.flatnonzero(word & (edge[:-1] | np.append(True, ~word[:-1])))
    ends = np.flatnonzero(word & (edge[1:] | np.append(~word[1:], True))) + 1
    values, found = _LOWER if lower else _PLAIN, np.zeros(len(begins), np.uint64)
    at = 0
    while at < len(begins):
        stop = max(at + 1, int(np.searchsorted(ends, begins[at] + _BLOCK, side="right")))
        low, high = begins[at], ends[stop - 1]
        up, down = powers(int(high - low))
        total = np.zeros(high - low + 1, np.uint64)
        np.cumsum(values[data[low:high]] * up[: high - low], out=total[1:])
        b, e = begins[at:stop] - low, ends[at:stop] - low
        found[at:stop] = (total[e] - total[b]) * down[b] + (e - b).astype(np.uint64)
        at = stop
    return mixed(found), np.searchsorted(begins, offsets)


def range_hashes(words: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hash of words[b:b + n] for each pair."""
    up, down = powers(len(words) + 1)
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up[: len(words)], out=total[1:])
    return mixed((total[begins + lengths] - total[begins]) * down[begins] + lengths.astype(np.uint64))
