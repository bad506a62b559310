"""Token counts by rank-synchronous merging of ragged arrays (operator 10).

Texts are cut at ASCII white space, which the vocabulary's own pre-tokenizer
never joins, and the distinct words of a batch are cut into pre-tokens. All
their symbols lie in one numpy array with a boundary array beside it. In each
round every pre-token finds its pair of lowest rank and merges all places of
that pair, all pre-tokens at once; finished pre-tokens leave the arrays. What is
left are the tokens.

Null texts count as empty, rows with a null id are counted like others, repeated
rows give repeated results, an empty table an empty result. Texts are never cut.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from recordmill.llm.shared import kept_by, pick, slices, sums, words_of

#: Counts of words kept between batches by a Python worker.
KEPT_WORDS = 1_000_000
_NO_RANK = np.iinfo(np.int64).max


class Merges:
    """A byte-level BPE file of the tokenizers library, as arrays."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        vocabulary, end = model["vocab"], model.get("end_of_word_suffix") or ""
        if model["type"] != "BPE" or model.get("dropout") or model.get("byte_fallback") or model.get("ignore_merges"):
            raise ValueError("only plain BPE vocabularies can be counted")
        self.width = len(vocabulary)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocabulary[a] for a, _ in pairs], np.int64)
        right = np.array([vocabulary[b] for _, b in pairs], np.int64)
        made = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        # Merging all places of the lowest pair at once equals merging them one by one only if
        # no merge makes a symbol that an earlier rank reads.
        made_at = np.full(self.width, -1, np.int64)
        made_at[made] = np.arange(len(made))
        if (np.maximum(made_at[left], made_at[right]) >= np.arange(len(made))).any():
            raise ValueError("the merges are not in the order of their making")
        keys = left * self.width + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made
        self.specials = [t["content"] for t in content.get("added_tokens", [])]
        self.special = re.compile("|".join(re.escape(x) for x in sorted(self.specials, key=len, reverse=True)) or "(?!)")
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in content.get("added_tokens", [])):
            raise ValueError("only plain special tokens can be counted")
        self.inside = {x: i for x, i in vocabulary.items() if len(x) == 1}
        self.last = {x: vocabulary[x + end] for x in self.inside if x + end in vocabulary}

    def pre_tokens(self, word: str) -> tuple[list[str], int]:
        """Pre-tokens of a word in byte letters, and the number of its special tokens."""
        pieces = self.special.split(word)
        return [x for piece in pieces for x in self.cut(piece)], len(pieces) - 1

    def cut(self, text: str) -> list[str]:
        normal = self.library.normalizer.normalize_str(text) if self.library.normalizer else text
        return [x for x, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def split(self, words: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """All pre-tokens; by word their number and that of special tokens; the order of the words in the first.

        Plain ASCII words are cut many at a time: each of their characters is one
        byte letter, so lengths tell which word a pre-token comes from.
        """
        found: list[str] = []
        parts, specials = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        plain = [i for i, w in enumerate(words) if w.isascii() and not self.special.search(w)]
        alone = sorted(set(range(len(words))).difference(plain))
        order = []
        for k in range(0, len(plain), 512):
            group = plain[k : k + 512]
            pieces = self.cut(" ".join([words[i] for i in group]))
            ends = np.cumsum([len(words[i]) for i in group])
            reached = np.cumsum([len(x) for x in pieces]) if pieces else np.zeros(0, np.int64)
            if len(reached) and reached[-1] == ends[-1] and np.isin(ends, reached).all():
                parts[group] = np.bincount(np.searchsorted(ends, reached), minlength=len(group))
                found += pieces
                order += group
            else:
                alone += group
        for i in alone:
            pieces, specials[i] = self.pre_tokens(words[i])
            parts[i] = len(pieces)
            found += pieces
        return found, parts, specials, np.array(order + alone, np.int64)

    def symbols(self, pre_tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """One array of symbols and the boundaries of the pre-tokens in it."""
        flat: list[int] = []
        for x in pre_tokens:
            flat.extend(map(self.inside.__getitem__, x[:-1]))
            flat.append(self.last[x[-1]])
        starts = np.zeros(len(pre_tokens) + 1, np.int64)
        np.cumsum([len(x) for x in pre_tokens], out=starts[1:])
        return np.array(flat, np.int64), starts

    def count(self, pre_tokens: list[str]) -> np.ndarray:
        """Surviving symbols of each pre-token."""
        symbols, starts = self.symbols(pre_tokens)
        counts = np.diff(starts)
        active = np.flatnonzero(counts > 1)
        lengths = counts[active]
        of = np.repeat(np.arange(len(active)), lengths)
        symbols = symbols[np.repeat(counts > 1, counts)]
        while len(symbols):
            keys = symbols[:-1] * self.width + symbols[1:]
            place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            rank = np.where((self.keys[place] == keys) & (of[:-1] == of[1:]), self.ranks[place], _NO_RANK)
            rank = np.append(rank, _NO_RANK)  # a rank per symbol: that of the pair it begins
            begins = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
            lowest = np.minimum.reduceat(rank, begins)
            lengths = np.diff(np.append(begins, len(symbols)))
            chosen = (rank == np.repeat(lowest, lengths)) & (rank != _NO_RANK)
            # of overlapping places (a a a) every second one, from the left
            at = np.flatnonzero(chosen)
            if len(at):
                run = np.append(True, (np.diff(at) > 1) | (of[at[1:]] != of[at[:-1]]))
                first = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
                at = at[(np.arange(len(at)) - first) % 2 == 0]
            symbols[at] = self.made[rank[at]]
            kept = np.ones(len(symbols), bool)
            kept[at + 1] = False
            left = np.add.reduceat(kept.astype(np.int64), begins)
            ended = (lowest == _NO_RANK) | (left == 1)
            counts[active[ended]] = left[ended]
            kept &= ~np.repeat(ended, lengths)
            symbols = symbols[kept]
            active, left = active[~ended], left[~ended]
            of = np.repeat(np.arange(len(active)), left)
        return counts


@functools.lru_cache(maxsize=2)
def merges(path: str) -> Merges:
    return Merges(path)


def word_counts(words: list[str], path: str) -> np.ndarray:
    """Tokens of each word; counts of up to ``KEPT_WORDS`` words are kept by the worker."""
    known = kept_by("token_counts").setdefault(path, {})
    new = [w for w in words if w not in known]
    if new:
        if len(known) + len(new) > KEPT_WORDS:
            known.clear()
            new = words
        model = merges(path)
        pieces, parts, totals, order = model.split(new)
        ends = np.concatenate([[0], np.cumsum(parts[order])])
        totals[order] += sums(model.count(pieces), ends)
        known.update(zip(new, totals.tolist(), strict=True))
    return np.fromiter(map(known.__getitem__, words), np.int64, len(words))


def _count(batches: Iterable[pa.RecordBatch], vocabulary: str, limit: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        words = words_of(batch.column(1))
        each = word_counts(words.strings(), vocabulary)
        total = sums(each[words.codes] if len(words.codes) else words.codes, words.starts)
        size = pc.cast(pc.binary_length(batch.column(1)), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), size, pa.array(total), pa.array(total > limit)],
            ["doc_id", "n_bytes", "n_tokens", "over_limit"],
        )


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 2048) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every whole text."""

    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    return pick(docs, "doc_id", "text").mapInArrow(lambda batches: _count(batches, vocabulary, limit), schema)
