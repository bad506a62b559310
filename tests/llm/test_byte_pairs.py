"""Byte-pair encoding and decoding against the tiktoken library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from recordmill.llm import byte_pairs, shared

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
ODD = ["", " ", "  ", "a ", " a  b \n c\n  ", "日本語テスト" * 50, "a" * 20_000, "x\n\ny  z\t \t", "<|endoftext|> it's 'll", "　x  \x85 y",
       "\x00a\x1c b", "=-" * 300, "\r\n \r\n", "é́ " * 20, "aaaaaaa aaaaaaab baaaaaaa", " 🎉🎉🎉 don't  don't"]


@pytest.fixture(scope="module")
def model():
    return byte_pairs.ranks_of(PATH, PATTERN)


@pytest.fixture(scope="module")
def library(model):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=model.ranks, special_tokens={})


def encoded(model, texts):
    ids, starts = model.encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(starts, starts[1:])]


def test_odd_texts_are_encoded_as_the_library_does(model, library):
    assert encoded(model, ODD) == [library.encode_ordinary(t) for t in ODD]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t'ae0.!é")), max_size=60), max_size=4))
def test_any_texts_are_encoded_and_decoded(texts):
    model = byte_pairs.ranks_of(PATH, PATTERN)
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=model.ranks, special_tokens={})
    assert encoded(model, texts) == [library.encode_ordinary(t) for t in texts]
    assert model.decode(*model.encode(pa.array(texts, pa.string()))) == [t.encode() for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \n\tab\x85\x1c　"), max_size=12), max_size=4))
def test_pieces_follow_each_other_without_a_gap(texts):
    chunks = shared.chunks_of(pa.array(texts, pa.string()))
    strings = chunks.strings()
    for text, a, b in zip(texts, chunks.starts, chunks.starts[1:]):
        own = [strings[c] for c in chunks.codes[a:b]]
        assert "".join(own) == text
        assert all(x[0] == " " and len(x) > 1 and not y[-1].isspace() for y, x in zip(own, own[1:]))


def test_long_words_are_merged_as_the_library_does(model, library):
    rng = random.Random(3)
    words = ["".join(rng.choice(letters) for _ in range(n)) for letters in ("abcdefgh", "ab", "日本語アé") for n in (60, 400)]
    assert model.encode_words([w.encode() for w in words]) == [np.array(library.encode_ordinary(w), "<u4").tobytes() for w in words]
    assert max(len(p) for p in model.parted(words[1].encode())) < 400


def test_pairs_that_rank_before_their_parts_are_merged_in_turn(tmp_path):
    """A vocabulary in which longer ids rank before the ids they are made of."""
    import base64

    tokens = [b"abcd", b"aab", b"ab", b"aa", b"cd", b"bc", b"aaaa", b"abab"]
    lines = [base64.b64encode(t) + b" " + str(i).encode() for i, t in enumerate(tokens + [bytes([b]) for b in range(256)])]
    path = tmp_path / "own.tiktoken"
    path.write_bytes(b"\n".join(lines))
    model = byte_pairs.Ranks(str(path), PATTERN)
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=model.ranks, special_tokens={})
    rng = random.Random(4)
    words = ["".join(rng.choice("abcd") for _ in range(rng.randrange(1, 90))) for _ in range(300)]
    assert model.encode_words([w.encode() for w in words]) == [np.array(library.encode_ordinary(w), "<u4").tobytes() for w in words]


def test_decoding_runs_and_unknown_ids(model, monkeypatch):
    monkeypatch.setattr(byte_pairs, "RUN", 7)
    texts = ["one two three four five six seven eight nine ten", "", "日本語" * 20]
    assert model.decode(*model.encode(pa.array(texts))) == [t.encode() for t in texts]
    with pytest.raises(ValueError):
        model.decode(np.array([1, 60_000]), np.array([0, 2]))


def test_round_trip(spark, rows, docs, none, clashing, library):
    def expected(doc_id, text):
        ids = library.encode_ordinary(text or "")
        return (-1 if doc_id is None else doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                hashlib.sha256((text or "").encode()).hexdigest())

    for table in (docs, clashing):
        got = byte_pairs.round_trip(table, PATH, PATTERN).collect()
        assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in got) == sorted(expected(*r[:2]) for r in rows)
    assert byte_pairs.round_trip(none, PATH, PATTERN).collect() == []
    texts = {(-1 if r[0] is None else r[0], (r[1] or "").encode()) for r in rows}
    back = byte_pairs.decode(byte_pairs.encode(docs, PATH, PATTERN), PATH, PATTERN).collect()
    assert len(back) == len(rows) and {(-1 if r[0] is None else r[0], bytes(r[1])) for r in back} == texts
